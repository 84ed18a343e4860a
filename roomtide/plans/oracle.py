"""The same answers as plain SQL, for checking the registered queries on another engine."""

from __future__ import annotations

from roomtide import schema
from roomtide.operators.records import BOOKING_FIELDS

# --- Shared parts -----------------------------------------------------------

PLACED = """placed AS (
  SELECT o.*, c.c_acctbal, c.c_mktsegment, n.n_name, n.n_regionkey, r.r_name,
         CAST(o_orderdate AS DATE) AS day, coalesce(n_lines, 0) AS n_lines, coalesce(n_returned, 0) AS n_returned
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned
             FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey)"""

BOOKINGS = PLACED + """,
bk AS (
  SELECT o_orderkey AS row_id, r_name AS hotel, 'P' || CAST(o_custkey // 150 AS VARCHAR) AS property, day AS stay_date,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_canceled,
         o_totalprice AS adr, CAST(o_orderkey % 300 AS INT) AS lead_time,
         o_orderpriority AS deposit_type, c_mktsegment AS segment,
         CAST(greatest(1, n_lines) AS INT) AS length_of_stay
  FROM placed)"""


def _pick(number: str, names: list[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(names[:-1]))
    return f"CASE {number} {cases} ELSE '{names[-1]}' END"


RAW_EXPRESSIONS = {
    "hotel": "CASE WHEN n_regionkey % 2 = 0 THEN 'City Hotel' ELSE 'Resort Hotel' END",
    "is_canceled": "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END",
    "lead_time": "CAST(o_orderkey % 300 AS INT)",
    "arrival_date_year": "year(day)",
    "arrival_date_month": "monthname(day)",
    "arrival_date_week_number": "weekofyear(day)",
    "arrival_date_day_of_month": "dayofmonth(day)",
    "stays_in_weekend_nights": "CAST(n_returned AS INT)",
    "stays_in_week_nights": "CAST(n_lines - n_returned AS INT)",
    "adults": "CASE WHEN c_acctbal < -970 THEN 0 ELSE CAST(1 + o_orderkey % 2 AS INT) END",
    "children": "CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN c_acctbal < -970 THEN 0 ELSE CAST(o_orderkey % 3 AS INT) END",
    "babies": "CASE WHEN c_acctbal < -970 THEN 0 WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END",
    "meal": _pick("o_orderkey % 5", ["BB", "FB", "HB", "SC", "Undefined"]),
    "country": "CASE WHEN o_orderkey % 89 <> 0 THEN substr(n_name, 1, 3) END",
    "market_segment": "c_mktsegment",
    "distribution_channel": _pick("o_orderkey % 4", ["Direct", "Corporate", "TA/TO", "GDS"]),
    "is_repeated_guest": "CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END",
    "previous_cancellations": "CAST(o_custkey % 3 AS INT)",
    "previous_bookings_not_canceled": "CAST(o_custkey % 5 AS INT)",
    "reserved_room_type": _pick("o_custkey % 3", ["A", "D", "E"]),
    "assigned_room_type": _pick("o_orderkey % 3", ["A", "D", "E"]),
    "booking_changes": "CAST(o_orderkey % 2 AS INT)",
    "deposit_type": "CASE o_orderpriority WHEN '1-URGENT' THEN 'Non Refund' WHEN '5-LOW' THEN 'Refundable' ELSE 'No Deposit' END",
    "agent": "CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_custkey % 40 AS INT) END",
    "company": "CASE WHEN o_orderkey % 17 = 0 THEN CAST(o_custkey % 25 AS INT) END",
    "days_in_waiting_list": "CASE WHEN o_orderkey % 29 = 0 THEN CAST(o_orderkey % 60 AS INT) ELSE 0 END",
    "customer_type": _pick("o_custkey % 4", ["Transient", "Contract", "Transient-Party", "Group"]),
    "adr": "(CASE WHEN c_acctbal >= -970 AND c_acctbal < -960 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END) * o_totalprice / 100",
    "required_car_parking_spaces": "CASE WHEN o_orderkey % 19 = 0 THEN 1 ELSE 0 END",
    "total_of_special_requests": "CAST(o_orderkey % 6 AS INT)",
    "reservation_status": "CASE WHEN o_orderstatus <> 'F' THEN 'Check-Out' WHEN o_orderkey % 10 = 0 THEN 'No-Show' ELSE 'Canceled' END",
    "reservation_status_date": "day",
}
RAW = (
    PLACED
    + ",\nraw AS (SELECT o_orderkey AS row_key, "
    + ", ".join(f"{text} AS {name}" for name, text in RAW_EXPRESSIONS.items())
    + " FROM placed)"
)

SPLIT = BOOKINGS + """,
sp AS (
  SELECT bk.*, CASE WHEN stay_date < m0 + INTERVAL 12 MONTH THEN 'train'
                    WHEN stay_date < m0 + INTERVAL 18 MONTH THEN 'validation'
                    WHEN stay_date < m0 + INTERVAL 21 MONTH THEN 'test' ELSE 'production' END AS split
  FROM bk, (SELECT date_trunc('month', min(stay_date)) AS m0 FROM bk))"""

SCORED = SPLIT + """,
sc AS (
  SELECT sp.*, coalesce(rate, overall) AS p_cancel
  FROM sp
  LEFT JOIN (SELECT hotel AS h, month(stay_date) AS m, avg(is_canceled) AS rate FROM sp
             WHERE split = 'train' GROUP BY 1, 2) r ON r.h = sp.hotel AND r.m = month(sp.stay_date),
       (SELECT avg(is_canceled) AS overall FROM sp WHERE split = 'train'))"""

# The same with the property as the hotel, for decisions by night.
SCORED_BY_PROPERTY = SCORED.replace("SELECT sp.*, coalesce", "SELECT sp.* REPLACE (sp.property AS hotel), coalesce")

OCCUPANCY = """
span AS (SELECT hotel, min(stay_date) AS d0, max(stay_date + length_of_stay) - 1 AS d1 FROM {rows} GROUP BY hotel),
nights AS (SELECT hotel, CAST(unnest(generate_series(d0::TIMESTAMP, d1::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS date FROM span),
occ AS (SELECT n.hotel, n.date, count(b.row_id) AS occupancy FROM nights n
        LEFT JOIN {rows} b ON b.hotel = n.hotel AND b.stay_date <= n.date AND n.date < b.stay_date + b.length_of_stay
        GROUP BY 1, 2)"""

DAY_CAPACITY = (
    """,
stayed AS (SELECT * FROM {source} WHERE is_canceled = 0),"""
    + OCCUPANCY.format(rows="stayed")
    + """,
dcap AS (SELECT hotel, CAST(round_even(quantile_cont(occupancy, 0.95), 0) AS INT) AS capacity FROM occ GROUP BY hotel)"""
)

WEEKS = SCORED + """,
wk AS (SELECT * REPLACE (property AS hotel, CAST(date_trunc('week', stay_date) AS DATE) AS stay_date) FROM sc),
wcap AS (SELECT hotel, CAST(round_even(quantile_cont(n, 0.5), 0) AS INT) AS capacity
         FROM (SELECT hotel, stay_date, count(*) AS n FROM wk GROUP BY 1, 2) GROUP BY hotel),
ranked AS (SELECT *, row_number() OVER (PARTITION BY hotel, stay_date ORDER BY lead_time DESC, row_id) AS rn FROM wk),
nt AS (SELECT hotel, stay_date, count(*) AS n, avg(adr) AS adr_ref FROM wk GROUP BY 1, 2),
rates AS (SELECT hotel, strftime(stay_date, '%Y-%m') AS month, avg(is_canceled) AS rate FROM wk GROUP BY 1, 2)"""


def _weekly(choices: str, more: str = "") -> str:
    """Independent-night backtest; ``choices`` gives (hotel, stay_date, policy, k, o)."""
    return (
        "WITH RECURSIVE "
        + WEEKS
        + more
        + f""",
choice AS ({choices}),
res AS (
  SELECT c.hotel, c.stay_date, c.policy, c.k, c.o, least(nt.n, capacity + c.o) AS accepted_n, capacity, adr_ref,
         sum(CASE WHEN rn <= capacity + c.o AND is_canceled = 0 THEN 1 ELSE 0 END) AS arrivals,
         sum(CASE WHEN rn <= capacity + c.o AND is_canceled = 0 THEN adr ELSE 0.0 END) AS revenue
  FROM choice c JOIN nt USING (hotel, stay_date) JOIN wcap USING (hotel) JOIN ranked r USING (hotel, stay_date)
  GROUP BY ALL),
final AS (
  SELECT hotel, stay_date, policy, k, CAST(o AS INT) AS o, CAST(accepted_n AS INT) AS accepted_n,
         CAST(arrivals AS INT) AS arrivals_actual, CAST(greatest(0, capacity - arrivals) AS INT) AS empty_rooms,
         CAST(greatest(0, arrivals - capacity) AS INT) AS moved_customers, revenue,
         greatest(0, capacity - arrivals) * adr_ref + greatest(0, arrivals - capacity) * k * adr_ref AS cost
  FROM res)"""
    )


LEVEL = {
    "no_overbook": "0",
    "fixed": "round_even(capacity * 0.1::DOUBLE, 0)",
    "avg_rate": "round_even(capacity * least(1.0::DOUBLE, greatest(0.0::DOUBLE, coalesce(rate, 0.05::DOUBLE))), 0)",
}


def _simple_choice(policies: list[str], ks: list[float]) -> str:
    parts = [
        f"""SELECT nt.hotel, nt.stay_date, '{policy}' AS policy, CAST({k} AS DOUBLE) AS k, CAST({LEVEL[policy]} AS INT) AS o
            FROM nt JOIN wcap USING (hotel)
            LEFT JOIN rates ON rates.hotel = nt.hotel AND rates.month = strftime(nt.stay_date, '%Y-%m')"""
        for policy in policies
        for k in ks
    ]
    return " UNION ALL ".join(parts)


NIGHT_ROWS = """ SELECT hotel, stay_date, policy, k, o, accepted_n, arrivals_actual, empty_rooms, moved_customers,
  round(revenue, 2) AS revenue, round(cost, 2) AS cost, round(revenue - cost, 2) AS profit FROM final"""

SUMMARY = """ SELECT {keys}, round(sum(revenue - cost), 0) AS total_profit, CAST(sum(moved_customers) AS BIGINT) AS total_moved,
  count(*) AS n_nights, round(sum(moved_customers) / count(*) * 1000, 6) AS moved_per_1000_nights
  FROM final GROUP BY {keys}"""

# Distribution of guests among the first m bookings of a night, one booking at a time.
LAW = """,
law AS (
  SELECT hotel, stay_date, 0 AS m, 0 AS s, 1.0::DOUBLE AS prob FROM {nights}
  UNION ALL
  SELECT l.hotel, l.stay_date, l.m + 1, l.s + t.d, sum(l.prob * CASE t.d WHEN 0 THEN b.p_cancel ELSE 1 - b.p_cancel END)
  FROM law l JOIN {ranked} b ON b.hotel = l.hotel AND b.stay_date = l.stay_date AND b.rn = l.m + 1,
       (VALUES (0), (1)) t(d)
  GROUP BY ALL)"""

WEEK_LEVELS = LAW.format(nights="nt", ranked="ranked") + """,
gap AS (SELECT hotel, stay_date, m, sum(prob * greatest(0, capacity - s)) AS e, sum(prob * greatest(0, s - capacity)) AS v
        FROM law JOIN wcap USING (hotel) GROUP BY 1, 2, 3),
tried AS (SELECT nt.hotel, nt.stay_date, nt.n, capacity, o, f.k, adr_ref * e + f.k * adr_ref * v AS cost
          FROM nt JOIN wcap USING (hotel), range(0, 1000) t(o), (VALUES {ks}) f(k), gap
          WHERE o <= greatest(1, floor(0.3::DOUBLE * capacity)) AND gap.hotel = nt.hotel AND gap.stay_date = nt.stay_date
            AND gap.m = least(nt.n, capacity + o)),
best AS (SELECT * FROM tried QUALIFY row_number() OVER (PARTITION BY hotel, stay_date, k ORDER BY round(cost, 5), o) = 1)"""

# --- Stays carried over -----------------------------------------------------

SEQUENCE = SCORED_BY_PROPERTY + DAY_CAPACITY.format(source="sc") + """,
drank AS (SELECT *, row_number() OVER (PARTITION BY hotel, stay_date ORDER BY lead_time DESC, row_id) AS rn FROM sc),
nb AS (SELECT hotel, stay_date, count(*) AS n, avg(adr) AS adr_ref,
              list({{'until': stay_date + length_of_stay, 'show': 1 - is_canceled, 'adr': adr}} ORDER BY rn) AS book
       FROM drank GROUP BY 1, 2),
cal AS (SELECT hotel, min(stay_date) AS d0, max(stay_date + length_of_stay) AS d1, avg(adr) AS mean_adr FROM sc GROUP BY hotel),
drates AS (SELECT hotel, strftime(stay_date, '%Y-%m') AS month, avg(is_canceled) AS rate FROM sc GROUP BY 1, 2),
choices AS (SELECT * FROM (VALUES {choices}) t(policy, k)),
{levels}
facts AS (SELECT n.hotel, n.date AS night, capacity, mean_adr, d1, coalesce(nb.n, 0) AS n, nb.adr_ref, nb.book,
                 CAST(round_even(capacity * 0.2::DOUBLE, 0) AS INT) AS o_fixed,
                 CAST(round_even(capacity * least(1.0::DOUBLE, greatest(0.0::DOUBLE, coalesce(rate, 0.05::DOUBLE))), 0) AS INT) AS o_rate
          FROM (SELECT hotel, d1, mean_adr, CAST(unnest(generate_series(d0::TIMESTAMP, (d1 - 1)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS date FROM cal) n
          JOIN dcap USING (hotel)
          LEFT JOIN nb ON nb.hotel = n.hotel AND nb.stay_date = n.date
          LEFT JOIN drates r ON r.hotel = n.hotel AND r.month = strftime(n.date, '%Y-%m')),
walk AS (
  SELECT cal.hotel, policy, CAST(k AS DOUBLE) AS k, d0 AS night, [{{'until': d0, 'show': 0, 'adr': 0.0::DOUBLE}}][2:] AS act
  FROM cal, choices
  UNION ALL
  SELECT hotel, policy, k, night + 1,
         list_filter(list_concat(act, list_filter(coalesce(book[1:accepted], []), lambda x: x.show = 1)), lambda x: x.until > night + 1)
  FROM (SELECT *, CAST(least(n, greatest(0, free + o)) AS INT) AS accepted
        FROM ({step})) WHERE night + 1 < d1),
outcome AS (
  SELECT *, CAST(least(n, greatest(0, free + o)) AS INT) AS accepted_n FROM ({step})),
shown AS (SELECT *, list_filter(coalesce(book[1:accepted_n], []), lambda x: x.show = 1) AS came FROM outcome),
counted AS (SELECT *, len(act) + len(came) AS arrivals,
                   coalesce(list_sum(list_transform(act, lambda x: x.adr)), 0.0) + coalesce(list_sum(list_transform(came, lambda x: x.adr)), 0.0) AS revenue,
                   CASE WHEN n > 0 THEN adr_ref ELSE mean_adr END AS price FROM shown),
final AS (
  SELECT hotel, night AS stay_date, policy, k, CAST(o AS INT) AS o, CAST(free AS INT) AS effective_capacity,
         CAST(len(act) AS INT) AS carryover_occupancy, accepted_n, CAST(arrivals AS INT) AS arrivals_actual,
         CAST(greatest(0, capacity - arrivals) AS INT) AS empty_rooms,
         CAST(greatest(0, arrivals - capacity) AS INT) AS moved_customers, revenue,
         greatest(0, capacity - arrivals) * price + greatest(0, arrivals - capacity) * k * price AS cost
  FROM counted)"""

STEP = """SELECT w.*, f.n, f.book, f.adr_ref, f.mean_adr, f.d1, f.capacity, greatest(0, f.capacity - len(w.act)) AS free,
  CASE w.policy WHEN 'no_overbook' THEN 0 WHEN 'fixed' THEN f.o_fixed WHEN 'avg_rate' THEN f.o_rate ELSE {model} END AS o
  FROM walk w JOIN facts f ON f.hotel = w.hotel AND f.night = w.night {join}"""

DAY_LEVELS = LAW.format(nights="nb", ranked="drank")[2:] + """,
spaces AS (SELECT hotel, unnest(range(1, capacity + 1)) AS free FROM dcap),
dgap AS (SELECT law.hotel, stay_date, m, free, sum(prob * greatest(0, free - s)) AS e, sum(prob * greatest(0, s - free)) AS v
         FROM law JOIN spaces USING (hotel) GROUP BY 1, 2, 3, 4),
dlev AS (SELECT nb.hotel, nb.stay_date, sp2.free, f.k, o, e + f.k * v AS cost
         FROM nb JOIN spaces sp2 ON sp2.hotel = nb.hotel, range(0, 1000) t(o),
              (SELECT DISTINCT CAST(k AS DOUBLE) AS k FROM choices) f, dgap
         WHERE o <= greatest(1, floor(0.3::DOUBLE * sp2.free)) AND dgap.hotel = nb.hotel AND dgap.stay_date = nb.stay_date
           AND dgap.free = sp2.free AND dgap.m = least(nb.n, sp2.free + o)),
dbest AS (SELECT hotel, stay_date, free, k, o FROM dlev
          QUALIFY row_number() OVER (PARTITION BY hotel, stay_date, free, k ORDER BY round(cost, 8), o) = 1),"""


def _sequential(policies: list[str], ks: list[float], scored: str | None = None) -> str:
    choices = ", ".join(f"('{p}', {k}::DOUBLE)" for p in policies for k in ks)
    if "model" in policies:
        on = "b.hotel = w.hotel AND b.stay_date = w.night AND b.k = w.k AND b.free = f.capacity - len(w.act)"
        step = STEP.format(model="coalesce(b.o, 0)", join=f"LEFT JOIN dbest b ON {on}")
        levels = DAY_LEVELS
    else:
        step, levels = STEP.format(model="0", join=""), ""
    body = SEQUENCE if scored is None else scored
    return "WITH RECURSIVE " + body.format(choices=choices, levels=levels, step=step)


SEQUENTIAL_ROWS = """ SELECT hotel, stay_date, policy, k, o, effective_capacity, carryover_occupancy, accepted_n, arrivals_actual,
  empty_rooms, moved_customers, round(revenue, 2) AS revenue, round(cost, 2) AS cost, round(revenue - cost, 2) AS profit FROM final"""

# --- Metrics ----------------------------------------------------------------

EDGES = [f"({i} * 0.1::DOUBLE)" for i in range(1, 10)]


def _bin(p: str, sign: str) -> str:
    return " + ".join(f"CASE WHEN {p} {sign} {edge} THEN 1 ELSE 0 END" for edge in EDGES)


LINES = """lines AS (SELECT l_linestatus AS alias, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
  l_extendedprice / 105000.0::DOUBLE AS p FROM lineitem)"""


def _metrics(rows: str, key: str, y: str = "y", p: str = "p") -> str:
    """CTE ``m`` with the five measures of ``rows`` by ``key``."""
    return f""",
eps AS (SELECT 2.220446049250313e-16::DOUBLE AS e),
d AS (SELECT {key} AS g, {p} AS p, count(*) AS n, sum({y}) AS pos FROM {rows} GROUP BY 1, 2),
cum AS (SELECT *, sum(n) OVER (PARTITION BY g ORDER BY p DESC) AS n_cum, sum(pos) OVER (PARTITION BY g ORDER BY p DESC) AS pos_cum,
               sum(n) OVER (PARTITION BY g) AS n_all, sum(pos) OVER (PARTITION BY g) AS pos_all FROM d),
rk AS (SELECT g, coalesce(sum(CAST(pos AS DOUBLE) * pos_cum / n_cum) / nullif(max(pos_all), 0), 0.0) AS pr_auc,
              sum((n - pos) * (pos_cum - pos + pos / 2)) / nullif(CAST(max(pos_all) AS DOUBLE) * (max(n_all) - max(pos_all)), 0) AS roc_auc
       FROM cum GROUP BY g),
ls AS (SELECT {key} AS g, count(*) AS n_rows,
              avg(-({y} * ln(greatest(e, least(1 - e, {p}))) + (1 - {y}) * ln(1 - greatest(e, least(1 - e, {p}))))) AS log_loss,
              avg(({p} - {y}) * ({p} - {y})) AS brier FROM {rows}, eps GROUP BY 1),
bn AS (SELECT {key} AS g, {_bin(p, '>=')} AS b, count(*) AS n, avg({y}) AS acc, avg({p}) AS conf FROM {rows} GROUP BY 1, 2),
ce AS (SELECT g, sum(n * abs(acc - conf)) / sum(n) AS ece FROM bn GROUP BY g),
m AS (SELECT ls.g, n_rows, pr_auc, roc_auc, log_loss, brier, ece FROM ls JOIN rk USING (g) JOIN ce USING (g))"""


# --- Validation -------------------------------------------------------------


def _date_parts_bad(months: str) -> str:
    return f"""arrival_date_year IS NOT NULL AND arrival_date_month IS NOT NULL AND arrival_date_day_of_month IS NOT NULL AND
 try_cast(printf('%04d-%02d-%02d', arrival_date_year, coalesce(list_position({months}, arrival_date_month), 0), arrival_date_day_of_month) AS DATE) IS NULL"""


def _rules(years: list[int], domains: dict[str, list[str]]) -> list[tuple[str, str, str, str]]:
    """(rule, column, condition of a bad row, text after the count) in report order."""

    def texts(values) -> str:
        return "(" + ", ".join(f"'{v}'" for v in values) + ")"

    months = "[" + ", ".join(f"'{m}'" for m in schema.MONTHS) + "]"
    out = []
    for c in schema.RAW_COLUMNS:
        if c not in schema.OPTIONAL_MISSING_COLUMNS:
            out.append(("missing", c, f"{c} IS NULL", "missing values"))
    for c in schema.BINARY_COLUMNS:
        out.append(("binary", c, f"{c} NOT IN (0, 1)", "invalid binary values"))
    for c in schema.NON_NEGATIVE_COLUMNS:
        out.append(("non_negative", c, f"{c} < 0", "negative values"))
    for c, top in schema.UPPER_BOUNDS.items():
        out.append(("upper_bound", c, f"{c} > {top}", f"values above maximum allowed value {top}"))
    for c, low in schema.LOWER_BOUNDS.items():
        out.append(("lower_bound", c, f"{c} < {low}", f"values below minimum allowed value {low}"))
    out.append(("month", "arrival_date_month", f"arrival_date_month NOT IN {texts(schema.MONTHS)}", "invalid month values"))
    allowed = "(" + ", ".join(str(y) for y in years) + ")"
    out.append(("year", "arrival_date_year", f"arrival_date_year NOT IN {allowed}", "invalid year values"))
    for c, values in domains.items():
        out.append(("category", c, f"{c} NOT IN {texts(values)}", "invalid category values"))
    out.append(("date", "arrival_date", _date_parts_bad(months), "invalid dates"))
    out.append(("date", "reservation_status_date", "FALSE", "invalid date values"))
    out.append(("guests", "guest_count", "coalesce(adults, 0) + coalesce(children, 0) + coalesce(babies, 0) = 0", "rows with zero guests"))
    return out


def _report(rows: str, years: list[int], domains: dict[str, list[str]]) -> str:
    parts = []
    for i, (rule, column, bad, text) in enumerate(_rules(years, domains)):
        n = f"count(*) FILTER (WHERE {bad})"
        parts.append(
            f"""SELECT {i} AS position, '{rule}' AS rule, '{column}' AS "column", {n} AS n_bad, '{column}: ' || {n} || ' {text}' AS message FROM {rows}"""
        )
    return " UNION ALL ".join(parts)


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

BROKEN = """,
broken AS (SELECT * REPLACE (
  CASE WHEN row_key = 0 THEN 2 ELSE is_canceled END AS is_canceled,
  CASE WHEN row_key = 1 THEN -10 ELSE lead_time END AS lead_time,
  CASE WHEN row_key = 2 THEN 'Januar' ELSE arrival_date_month END AS arrival_date_month,
  CASE WHEN row_key = 3 THEN -50.0::DOUBLE ELSE adr END AS adr,
  CASE WHEN row_key = 4 THEN 3 ELSE is_repeated_guest END AS is_repeated_guest) FROM raw)"""


def _typed() -> str:
    rules = []

    def add(rule: str, column: str, bad: str) -> None:
        rules.append((rule, column, bad))

    hotels = ", ".join(f"'{h}'" for h in schema.DOMAINS["hotel"])
    months = ", ".join(f"'{m}'" for m in schema.MONTHS)
    years = ", ".join(str(y) for y in schema.YEARS)
    tests = {
        "hotel": ("declared_values", f"hotel NOT IN ({hotels})"),
        "is_canceled": ("declared_values", "is_canceled NOT IN (0, 1)"),
        "arrival_date_year": ("declared_values", f"arrival_date_year NOT IN ({years})"),
        "arrival_date_month": ("declared_values", f"arrival_date_month NOT IN ({months})"),
        "lead_time": ("declared_minimum", "lead_time < 0"),
        "adr": ("declared_minimum", "adr < 0"),
        "is_repeated_guest": ("declared_values", "is_repeated_guest NOT IN (0, 1)"),
    }
    for column, (rule, bad) in tests.items():
        add("declared_null", column, f"{column} IS NULL")
        add(rule, column, bad)
    return " UNION ALL ".join(
        f"""SELECT {i} AS position, '{rule}' AS rule, '{column}' AS "column", count(*) FILTER (WHERE {bad}) AS n_bad FROM raw"""
        for i, (rule, column, bad) in enumerate(rules)
    )


def _missing() -> str:
    parts = [
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM raw""" for c in ["row_key", *schema.RAW_COLUMNS]
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE n_missing > 0"


def _problems() -> str:
    parts = []
    wrong = {"lead_time": ("row_key % 67 IN (1, 2)", "must be a whole number"), "adr": ("row_key % 71 = 2", "must be a number")}
    for name, field in BOOKING_FIELDS.items():
        tests, typed = [], ""
        if name in wrong:
            tests.append(wrong[name])
            typed = f" AND NOT {wrong[name][0]}".replace("NOT row_key % 67 IN (1, 2)", "row_key % 67 NOT IN (1, 2)").replace("NOT row_key % 71 = 2", "row_key % 71 <> 2")
        if field.required:
            tests.append((f"{name} IS NULL", "field required"))
        if field.at_least is not None:
            tests.append((f"{name} < {field.at_least}{typed}", f"must be at least {field.at_least:g}"))
        if field.at_most is not None:
            tests.append((f"{name} > {field.at_most}", f"must be at most {field.at_most:g}"))
        if field.allowed is not None:
            values = ", ".join(f"'{v}'" for v in field.allowed)
            tests.append((f"{name} NOT IN ({values})", "not an allowed value"))
        parts += [f"SELECT row_key, '{name}' AS field, '{text}' AS message FROM raw WHERE {bad}" for bad, text in tests]
    guests = "coalesce(adults, 0) + coalesce(children, 0) + coalesce(babies, 0) = 0"
    parts.append(
        f"SELECT row_key, 'guests' AS field, 'no guests: adults, children and babies are all 0' AS message FROM raw WHERE {guests}"
    )
    return " UNION ALL ".join(parts)


CLEANED = RAW + f""",
flagged AS (SELECT *, count(*) OVER (PARTITION BY {', '.join(schema.RAW_COLUMNS)}) > 1 AS is_duplicate FROM raw),
clean AS (SELECT row_number() OVER (ORDER BY row_key) - 1 AS row_id, *, reservation_status_date AS arrival_date,
                 reservation_status_date - lead_time AS booking_date
          FROM flagged WHERE NOT coalesce(adr < 0, FALSE)
            AND coalesce(adults, 0) + coalesce(children, 0) + coalesce(babies, 0) <> 0)"""

FEATURE_COLUMNS = """lead_time, arrival_date_month, arrival_date_week_number, arrival_date_day_of_month, stays_in_weekend_nights,
  stays_in_week_nights, adults, coalesce(children, 0) AS children, babies, meal, coalesce(country, 'Unknown') AS country,
  market_segment, distribution_channel, is_repeated_guest, previous_cancellations, previous_bookings_not_canceled,
  reserved_room_type, deposit_type, coalesce(CAST(agent AS VARCHAR), 'Unknown') AS agent,
  coalesce(CAST(company AS VARCHAR), 'Unknown') AS company, customer_type,
  CASE WHEN country IS NULL THEN 1 ELSE 0 END AS country_missing, CASE WHEN agent IS NULL THEN 1 ELSE 0 END AS agent_missing,
  CASE WHEN company IS NULL THEN 1 ELSE 0 END AS company_missing, CASE WHEN children IS NULL THEN 1 ELSE 0 END AS children_missing"""

COPIES = "l_suppkey, l_quantity, l_discount, l_returnflag"

# --- Drift ------------------------------------------------------------------

PRODUCTION = SCORED + """,
pw AS (SELECT *, CAST(floor(date_diff('day', d0, stay_date) / 7) AS INT) + 1 AS week
       FROM sc, (SELECT min(stay_date) AS d0 FROM sc WHERE split = 'production') WHERE split = 'production')"""

EVENTS = """ev AS (SELECT *, CAST(floor(date_diff('day', d0, CAST(ts AS DATE)) / 7) AS INT) + 1 AS week
  FROM events, (SELECT CAST(min(ts) AS DATE) AS d0 FROM events))"""


def _long(rows: str, columns: list[str], keys: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}'{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {rows} WHERE {c} IS NOT NULL" for c in columns
    )


def _js(reference: str, current: str, columns: list[str]) -> str:
    """CTE ``js`` (week, chunk, feature, js_distance); ``current`` has week and chunk."""
    levels = ", ".join(f"quantile_cont(value, {i / 10})" for i in range(1, 10))
    return f""",
rl AS ({_long(reference, columns)}),
cl AS ({_long(current, columns, 'week, chunk, ')}),
ed AS (SELECT feature, list_sort(list_distinct([{levels}])) AS edges FROM rl GROUP BY feature),
rb AS (SELECT feature, len(list_filter(edges, lambda x: x < value)) AS bin, count(*) AS n FROM rl JOIN ed USING (feature) GROUP BY 1, 2),
cb AS (SELECT week, chunk, feature, len(list_filter(edges, lambda x: x < value)) AS bin, count(*) AS n FROM cl JOIN ed USING (feature) GROUP BY 1, 2, 3, 4),
bins AS (SELECT feature, unnest(range(0, len(edges) + 1)) AS bin FROM ed),
ps AS (SELECT b.feature, b.bin, coalesce(n, 0) / (SELECT sum(n) FROM rb x WHERE x.feature = b.feature) AS p
       FROM bins b LEFT JOIN rb ON rb.feature = b.feature AND rb.bin = b.bin),
tot AS (SELECT week, chunk, feature, sum(n) AS t FROM cb GROUP BY 1, 2, 3),
qs AS (SELECT tot.week, tot.chunk, ps.feature, ps.bin, p, coalesce(cb.n, 0) / t AS q FROM tot JOIN ps USING (feature)
       LEFT JOIN cb ON cb.week = tot.week AND cb.chunk = tot.chunk AND cb.feature = ps.feature AND cb.bin = ps.bin),
js AS (SELECT week, chunk, feature, sqrt(greatest(0.0, sum(
         (CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2))) AS js_distance
       FROM qs GROUP BY 1, 2, 3)"""


EVENT_CHUNKS = EVENTS + """,
eref AS (SELECT * FROM ev WHERE week = 1),
ecur AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY week ORDER BY ts, event_id) - 1)
                              / greatest(100, least(500, count(*) OVER (PARTITION BY week)))) AS INT) AS chunk
         FROM ev WHERE week > 1)"""

DRIFT_COLUMNS = ["lead_time", "adr", "length_of_stay"]

DECISIONS = (
    PRODUCTION
    + """,
tr AS (SELECT * FROM sc WHERE split = 'train'),
pc AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY week ORDER BY stay_date, row_id) - 1)
                            / greatest(100, least(500, count(*) OVER (PARTITION BY week)))) AS INT) AS chunk FROM pw),
marked AS (SELECT 0 AS week, is_canceled, p_cancel FROM sc WHERE split = 'test'
           UNION ALL SELECT week, is_canceled, p_cancel FROM pw)"""
    + _js("tr", "pc", DRIFT_COLUMNS)
    + _metrics("marked", "week", "is_canceled", "p_cancel")
    + """,
base AS (SELECT pr_auc AS base_ap FROM m WHERE g = 0),
wkst AS (SELECT week, count(*) AS n_rows, avg(is_canceled) AS rate, max(stay_date) + 1 AS cutoff FROM pw GROUP BY week),
al AS (SELECT week, count(*) FILTER (WHERE js_distance > 0.35) AS n_alerts FROM js GROUP BY week),
dec AS (
  SELECT wkst.week, wkst.n_rows, rate, list_filter([
      CASE WHEN n_alerts > 0 THEN 'Data drift detected ' || n_alerts || ' drift alert(s)' END,
      CASE WHEN abs(rate - (SELECT avg(is_canceled) FROM tr)) > 0.05::DOUBLE THEN 'Cancellation-rate gap exceeded 5%' END,
      CASE WHEN base_ap - pr_auc > 0.03::DOUBLE THEN 'Concept/performance drift: PR-AUC dropped by ' || printf('%.4f', base_ap - pr_auc) || ' (>0.03)' END,
      CASE WHEN ece > 0.05::DOUBLE THEN 'Concept/performance drift: ECE ' || printf('%.4f', ece + 1e-9) || ' >0.05' END],
    lambda x: x IS NOT NULL) AS reasons
  FROM wkst JOIN al USING (week) JOIN m ON m.g = wkst.week, base)"""
)


def _fold(signals: str, key: str) -> str:
    """CTE ``fold`` (key, week, action): the cooldown, one week after another."""
    return f""",
sig AS (SELECT {key} AS g, week, signal, row_number() OVER (PARTITION BY {key} ORDER BY week) AS i FROM {signals}),
fold AS (
  SELECT g, i, week, CASE WHEN signal THEN week END AS last, CASE WHEN signal THEN 'would retrain (dry run)' ELSE '-' END AS action
  FROM sig WHERE i = 1
  UNION ALL
  SELECT s.g, s.i, s.week,
         CASE WHEN s.signal AND (f.last IS NULL OR s.week - f.last >= 4) THEN s.week ELSE f.last END,
         CASE WHEN NOT s.signal THEN '-' WHEN f.last IS NULL OR s.week - f.last >= 4 THEN 'would retrain (dry run)'
              ELSE 'skipped (cooldown until week ' || (f.last + 4) || ')' END
  FROM fold f JOIN sig s ON s.g = f.g AND s.i = f.i + 1)"""


SPLIT_STATS = "min(stay_date) AS start_date, max(stay_date) AS end_date"

REQUESTS = """,
asked AS (SELECT CASE WHEN lead_time % 50 = 0 THEN 'EUROPE' ELSE hotel END AS request_hotel, hotel, stay_date,
                 CASE WHEN dayofmonth(stay_date) % 7 <> 0 THEN dayofyear(stay_date) % 9 END AS taken,
                 dayofmonth(stay_date) % 13 - 1 AS adr_ref, CASE WHEN dayofmonth(stay_date) % 11 <> 0 THEN dayofmonth(stay_date) % 5 END AS k FROM bk),
groups AS (SELECT request_hotel || '/' || stay_date AS request_id, count(*) AS n_bookings,
                  count(*) FILTER (WHERE hotel <> request_hotel) AS n_other_hotel, max(taken) AS already_occupied,
                  min(adr_ref) AS adr_ref, min(k) AS k, max(request_hotel) AS hotel FROM asked GROUP BY 1)"""

LOG = """log AS (SELECT ts, event_id AS id, event_type AS path, value AS ms,
  CASE WHEN event_type = 'error' THEN 500 WHEN user_id % 10 = 0 THEN 404 ELSE 200 END AS status FROM events)"""


def _gate() -> str:
    """Both models walked by the model policy on the test months, and the metrics of both."""
    walked = []
    for alias, key in (("candidate", "AND r.m = month(sp.stay_date)"), ("champion", "")):
        rates = "hotel AS h, month(stay_date) AS m" if key else "hotel AS h"
        walked.append(
            f"""SELECT '{alias}' AS alias, sp.* REPLACE (sp.property AS hotel), coalesce(rate, overall) AS p_cancel FROM sp
  LEFT JOIN (SELECT {rates}, avg(is_canceled) AS rate FROM sp WHERE split = 'train' GROUP BY ALL) r ON r.h = sp.hotel {key},
  (SELECT avg(is_canceled) AS overall FROM sp WHERE split = 'train') WHERE sp.split = 'test'"""
        )
    both = (
        SPLIT
        + ",\ntrained AS (SELECT * REPLACE (property AS hotel) FROM sp WHERE split = 'train')"
        + DAY_CAPACITY.format(source="trained").replace("dcap AS (SELECT hotel,", "dcap0 AS (SELECT hotel,")
        + f",\nsides AS ({' UNION ALL '.join(walked)}),\n"
        # a hotel is walked once per model: its name carries the model
        + "sc AS (SELECT * REPLACE (alias || '/' || hotel AS hotel) FROM sides),\n"
        + "dcap AS (SELECT a || '/' || hotel AS hotel, capacity FROM dcap0, (VALUES ('candidate'), ('champion')) t(a))"
    )
    body = both + SEQUENCE[len(SCORED_BY_PROPERTY + DAY_CAPACITY.format(source="sc")):].replace("coalesce(rate, 0.05::DOUBLE)", "0.05::DOUBLE")
    walk = _sequential(["model"], [2.0], body)
    return (
        walk
        + ",\nprofits AS (SELECT split_part(hotel, '/', 1) AS alias, sum(revenue - cost) AS profit FROM final GROUP BY 1)"
        + _metrics("sides", "alias", "is_canceled", "p_cancel")
        + """,
r4 AS (SELECT g, round(pr_auc, 4) AS pr_auc, round(ece, 4) AS ece, round(brier, 4) AS brier FROM m),
one AS (SELECT c.pr_auc AS c_ap, c.ece AS c_ece, c.brier AS c_brier, h.pr_auc AS h_ap, h.ece AS h_ece, h.brier AS h_brier,
               (SELECT profit FROM profits WHERE alias = 'candidate') AS c_profit,
               (SELECT profit FROM profits WHERE alias = 'champion') AS h_profit
        FROM r4 c, r4 h WHERE c.g = 'candidate' AND h.g = 'champion'),
bad AS (SELECT *, CASE WHEN c_ece > 0.05::DOUBLE THEN 1 ELSE 0 END + CASE WHEN c_ap < h_ap - 0.03::DOUBLE THEN 1 ELSE 0 END
               + CASE WHEN round(c_profit, 4) < round(h_profit, 4) THEN 1 ELSE 0 END AS n_reasons FROM one)
SELECT '2000-05-31' AS cutoff, n_reasons = 0 AS passed, n_reasons, c_ap AS candidate_pr_auc, c_ece AS candidate_ece,
       c_brier AS candidate_brier, h_ap AS champion_pr_auc, h_ece AS champion_ece, h_brier AS champion_brier,
       round(c_profit, 1) AS profit_candidate, round(h_profit, 1) AS profit_champion FROM bad"""
    )


# --- One text per query -----------------------------------------------------

SQL: dict[str, str] = {
    "csv_scan": f"""WITH {RAW} SELECT hotel, deposit_type, count(*) AS n, round(sum(adr), 1) AS adr,
        CAST(sum(lead_time) AS BIGINT) AS lead_time, count(agent) AS n_agent, min(reservation_status_date) AS first_day FROM raw GROUP BY 1, 2""",
    "csv_dates": "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, count(*) AS n FROM orders GROUP BY 1",
    "partitioned_sink": f"WITH {SPLIT} SELECT split, count(*) AS n_rows, round(sum(adr), 1) AS adr FROM sp GROUP BY 1",
    "json_documents": f"""WITH {DECISIONS} SELECT len(reasons) > 0 AS retrain, count(*) AS n_weeks, CAST(sum(len(reasons)) AS BIGINT) AS n_reasons
        FROM dec GROUP BY 1""",
    "validation_report": f"WITH {RAW} {_report('raw', schema.YEARS, schema.DOMAINS)}",
    "bad_cells_report": f"""WITH {RAW}{BROKEN} SELECT * FROM
        ({_report('broken', list(range(1990, 2005)), {**schema.DOMAINS, 'market_segment': SEGMENTS})}) WHERE n_bad > 0""",
    "typed_schema_report": f"WITH {RAW} {_typed()}",
    "missingness": f"WITH {RAW} {_missing()}",
    "duplicate_flags": f"SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY {COPIES}) > 1 AS is_duplicate FROM lineitem",
    "duplicate_totals": f"""SELECT CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS all_members, CAST(sum(n - 1) AS BIGINT) AS extra_copies
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY {COPIES})""",
    "clean_filter": f"""WITH {CLEANED} SELECT row_key, round(adr, 4) AS adr, adults, children, babies FROM clean""",
    "removal_rate": f"""WITH {RAW}, t AS (SELECT *, coalesce(adr < 0, FALSE) AS neg,
        coalesce(adults, 0) + coalesce(children, 0) + coalesce(babies, 0) = 0 AS nobody FROM raw)
        SELECT count(*) AS n_rows, count(*) FILTER (WHERE neg) AS n_negative_price, count(*) FILTER (WHERE nobody) AS n_zero_guests,
        count(*) FILTER (WHERE neg OR nobody) AS n_removed, round(count(*) FILTER (WHERE neg OR nobody) / count(*) * 100, 6) AS percent FROM t""",
    "clean_bookings": f"WITH {CLEANED} SELECT row_id, hotel, lead_time, is_duplicate, arrival_date, booking_date, round(adr, 4) AS adr FROM clean",
    "row_numbers": "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_id, o_orderkey FROM orders",
    "flipped_labels": f"""WITH {BOOKINGS} SELECT row_id, CASE WHEN row_number() OVER (ORDER BY row_id) <= floor(0.40::DOUBLE * (SELECT count(*) FROM bk))
        THEN 1 - is_canceled ELSE is_canceled END AS is_canceled FROM bk""",
    "temporal_split_stats": f"""WITH {SPLIT} SELECT split, count(*) AS n_rows, round(count(*) * 100 / (SELECT count(*) FROM sp), 6) AS percent,
        {SPLIT_STATS}, round(avg(is_canceled), 6) AS cancellation_rate FROM sp GROUP BY split""",
    "split_order": f"""WITH {SPLIT}, t AS (SELECT split, {SPLIT_STATS} FROM sp GROUP BY split)
        SELECT earlier, later, a.end_date AS earlier_end, b.start_date AS later_start, coalesce(a.end_date < b.start_date, FALSE) AS in_order
        FROM (VALUES ('train', 'validation'), ('validation', 'test'), ('test', 'production')) p(earlier, later)
        LEFT JOIN t a ON a.split = earlier LEFT JOIN t b ON b.split = later""",
    "split_overlap": f"""WITH {SPLIT}, u AS (SELECT DISTINCT split, hotel, segment, deposit_type, lead_time, is_canceled FROM sp),
        pairs AS (SELECT * FROM (VALUES ('train', 'validation'), ('train', 'test'), ('train', 'production'), ('validation', 'test'),
          ('validation', 'production'), ('test', 'production')) p(split_a, split_b))
        SELECT split_a, split_b, count(b.hotel) AS n_shared FROM pairs LEFT JOIN u a ON a.split = split_a
        LEFT JOIN u b ON b.split = split_b AND b.hotel = a.hotel AND b.segment = a.segment AND b.deposit_type = a.deposit_type
          AND b.lead_time = a.lead_time AND b.is_canceled = a.is_canceled GROUP BY 1, 2""",
    "split_completeness": f"WITH {SPLIT} SELECT (SELECT count(*) FROM bk) AS n_original, count(*) AS n_split, (SELECT count(*) FROM bk) = count(*) AS complete FROM sp",
    "manifest_stats": f"""WITH {SPLIT} SELECT 'stay_date' AS split_method, 12 AS train_months, split, count(*) AS rows, {SPLIT_STATS},
        round(avg(is_canceled), 6) AS cancellation_rate FROM sp GROUP BY split""",
    "retrain_window": f"""WITH {BOOKINGS}, t AS (SELECT *, CASE WHEN stay_date >= DATE '1998-08-31' AND stay_date < DATE '1999-08-31' THEN 'train'
          WHEN stay_date >= DATE '1999-08-31' AND stay_date < DATE '2000-02-29' THEN 'validation'
          WHEN stay_date >= DATE '2000-02-29' AND stay_date < DATE '2000-05-31' THEN 'test' END AS split FROM bk)
        SELECT split, count(*) AS n_rows, {SPLIT_STATS}, round(avg(is_canceled), 6) AS cancellation_rate FROM t WHERE split IS NOT NULL GROUP BY split""",
    "rate_by_month_hotel": f"""WITH {SPLIT} SELECT strftime(stay_date, '%Y-%m') AS arrival_month, hotel, count(*) AS bookings,
        CAST(sum(is_canceled) AS BIGINT) AS cancellations, round(avg(is_canceled), 6) AS cancellation_rate
        FROM sp WHERE split = 'train' GROUP BY 1, 2""",
    "split_comparison": f"""WITH {SPLIT} SELECT split, count(*) AS n_rows,
        round(100 * count(*) FILTER (WHERE hotel = 'ASIA') / count(hotel), 6) AS "hotel_ASIA_pct",
        round(100 * count(*) FILTER (WHERE hotel = 'EUROPE') / count(hotel), 6) AS "hotel_EUROPE_pct",
        round(100 * count(*) FILTER (WHERE deposit_type = '1-URGENT') / count(deposit_type), 6) AS "deposit_URGENT_pct",
        0.0::DOUBLE AS deposit_absent_pct, round(avg(lead_time), 6) AS lead_time_mean, round(median(lead_time), 6) AS lead_time_median,
        round(avg(is_canceled), 6) AS cancellation_rate FROM sp GROUP BY split""",
    "class_balance": f"WITH {BOOKINGS} SELECT is_canceled AS label, count(*) AS n, round(count(*) / (SELECT count(*) FROM bk), 6) AS share FROM bk GROUP BY 1",
    "profile_rate": f"""WITH {BOOKINGS} SELECT deposit_type, segment, count(*) AS n, round(avg(is_canceled), 6) AS rate,
        round(avg(adr), 3) AS adr_mean, round(stddev_samp(adr), 3) AS adr_std, round(count(*) / (SELECT count(*) FROM bk), 6) AS share
        FROM bk GROUP BY 1, 2""",
    "distinct_nights": f"WITH {BOOKINGS} SELECT count(DISTINCT hotel) AS n_hotel, count(DISTINCT stay_date) AS n_stay_date FROM bk",
    "exact_quantiles": f"""WITH {BOOKINGS} SELECT hotel, round(quantile_cont(adr, 0.25), 4) AS p25, round(quantile_cont(adr, 0.5), 4) AS p50,
        round(quantile_cont(adr, 0.95), 4) AS p95 FROM bk GROUP BY hotel""",
    "baseline_predict": f"WITH {SCORED} SELECT row_id, round(p_cancel, 8) AS p_cancel FROM sc",
    "feature_build": f"WITH {CLEANED} SELECT row_id, hotel, days_in_waiting_list, round(adr, 4) AS adr, {FEATURE_COLUMNS} FROM clean",
    "features_without_team_columns": f"""WITH {CLEANED}, f AS (SELECT hotel, {FEATURE_COLUMNS} FROM clean WHERE NOT is_duplicate)
        SELECT hotel, agent, count(*) AS n, CAST(sum(company_missing) AS BIGINT) AS no_company FROM f GROUP BY 1, 2""",
    "request_defaults": f"""WITH {RAW} SELECT row_key, coalesce(children, 0) AS children, 0 AS babies, CAST(NULL AS INT) AS agent,
        0 AS previous_cancellations, country, lead_time FROM raw""",
    "quarantine": f"WITH {RAW} {_problems()}",
    "request_groups": f"""WITH {BOOKINGS}{REQUESTS} SELECT request_id, n_bookings, n_other_hotel, already_occupied, array_to_string(list_filter([
          CASE WHEN n_bookings > 1000 THEN 'bookings' END, CASE WHEN n_other_hotel > 0 THEN 'hotel' END, CASE WHEN hotel = 'ASIA' THEN 'hotel' END,
          CASE WHEN already_occupied IS NULL OR already_occupied > 6 THEN 'already_occupied' END,
          CASE WHEN adr_ref <= 0 THEN 'adr_ref' END, CASE WHEN k <= 0 THEN 'k' END], lambda x: x IS NOT NULL), ',') AS fields FROM groups""",
    "arrivals_departures": f"""WITH {BOOKINGS} SELECT hotel, date, CAST(sum(a) AS BIGINT) AS arrivals, CAST(sum(d) AS BIGINT) AS departures FROM (
        SELECT hotel, stay_date AS date, 1 AS a, 0 AS d FROM bk WHERE is_canceled = 0 UNION ALL
        SELECT hotel, stay_date + length_of_stay, 0, 1 FROM bk WHERE is_canceled = 0) GROUP BY 1, 2""",
    "nightly_occupancy": f"WITH {BOOKINGS}, stayed AS (SELECT * FROM bk WHERE is_canceled = 0),{OCCUPANCY.format(rows='stayed')} SELECT * FROM occ",
    "nightly_occupancy_by_night": f"WITH {BOOKINGS}, stayed AS (SELECT * FROM bk WHERE is_canceled = 0),{OCCUPANCY.format(rows='stayed')} SELECT * FROM occ",
    "capacity_p95": f"WITH {BOOKINGS}{DAY_CAPACITY.format(source='bk')} SELECT * FROM dcap",
    "stay_columns": f"""WITH {RAW}, t AS (SELECT row_key, reservation_status_date AS stay_date,
        greatest(1, stays_in_weekend_nights + stays_in_week_nights) AS length_of_stay FROM raw)
        SELECT row_key, stay_date, length_of_stay, stay_date + length_of_stay AS checkout_date FROM t""",
    "monthly_rates": f"WITH {BOOKINGS} SELECT hotel, strftime(stay_date, '%Y-%m') AS month, round(avg(is_canceled), 8) AS rate FROM bk GROUP BY 1, 2",
    "night_summary": f"""WITH {SCORED} SELECT hotel, stay_date, count(*) AS n_new_bookings, round(avg(p_cancel), 6) AS mean_p_cancel,
        round(sum(1 - p_cancel), 6) AS expected_show_ups, round(avg(adr), 3) AS adr_ref FROM sc GROUP BY 1, 2""",
    "backtest_no_overbook": _weekly(_simple_choice(["no_overbook"], [2.0])) + NIGHT_ROWS,
    "backtest_fixed": _weekly(_simple_choice(["fixed"], [2.0])) + NIGHT_ROWS,
    "backtest_avg_rate": _weekly(_simple_choice(["avg_rate"], [2.0])) + NIGHT_ROWS,
    "backtest_model": _weekly(
        "SELECT hotel, stay_date, 'model' AS policy, k, o FROM best", WEEK_LEVELS.format(ks="(1.5::DOUBLE), (3.0::DOUBLE)")
    )
    + NIGHT_ROWS,
    "policy_summary": _weekly(_simple_choice(["no_overbook", "fixed", "avg_rate"], [2.0])) + SUMMARY.format(keys="policy"),
    "k_sensitivity": _weekly(_simple_choice(["no_overbook", "fixed", "avg_rate"], [1.5, 2.0, 3.0])) + SUMMARY.format(keys="policy, k"),
    "optimal_overbook": f"""WITH RECURSIVE {WEEKS}{WEEK_LEVELS.format(ks='(2.0::DOUBLE)')}
        SELECT hotel, stay_date, capacity, n AS n_bookings, CAST(o AS INT) AS o_star, round(cost, 2) AS expected_cost FROM best""",
    "guest_law": f"""WITH RECURSIVE {WEEKS}, kept AS (SELECT ranked.* FROM ranked JOIN wcap USING (hotel) WHERE rn <= 2 * capacity){LAW.format(nights='nt', ranked='kept')}
        SELECT DISTINCT hotel, stay_date, CAST(o AS INT) AS o, s AS guests, round(prob, 8) AS probability
        FROM law JOIN nt USING (hotel, stay_date) JOIN wcap USING (hotel),
          LATERAL (SELECT unnest([0, 1, capacity]) AS o) WHERE m = least(n, capacity + o)""",
    "sequential_backtest": _sequential(["no_overbook", "fixed", "avg_rate"], [2.0]) + SEQUENTIAL_ROWS,
    "sequential_model": _sequential(["model"], [1.5, 3.0]) + SEQUENTIAL_ROWS,
    "sequential_summary": _sequential(["no_overbook", "fixed", "avg_rate", "model"], [2.0]) + SUMMARY.format(keys="policy"),
    "model_quality": f"""WITH {LINES}{_metrics('lines', 'alias')} SELECT g AS alias, n_rows, round(pr_auc, 8) AS pr_auc, round(roc_auc, 8) AS roc_auc,
        round(log_loss, 8) AS log_loss, round(brier, 8) AS brier, round(ece, 8) AS ece FROM m""",
    "average_precision": f"WITH {SCORED}{_metrics('sc', 'split', 'is_canceled', 'p_cancel')} SELECT g AS split, n_rows, round(pr_auc, 8) AS pr_auc FROM m",
    "roc_auc": f"WITH {SCORED}{_metrics('sc', 'split', 'is_canceled', 'p_cancel')} SELECT g AS split, round(roc_auc, 8) AS roc_auc FROM m",
    "log_loss_brier": f"""WITH {SCORED}{_metrics('sc', 'hotel', 'is_canceled', 'p_cancel')}
        SELECT g AS hotel, round(log_loss, 8) AS log_loss, round(brier, 8) AS brier FROM m""",
    "ece": f"WITH {LINES}{_metrics('lines', 'alias')} SELECT g AS alias, round(ece, 8) AS ece FROM m",
    "reliability_curve": f"""WITH {LINES} SELECT alias, {_bin('p', '>')} AS bin, count(*) AS n, round(avg(p), 8) AS prob_pred,
        round(avg(y), 8) AS prob_true FROM lines GROUP BY 1, 2""",
    "metrics_by_stage": f"""WITH {SCORED}, st AS (SELECT 'before' AS stage, is_canceled, sqrt(p_cancel) AS p FROM sc
          UNION ALL SELECT 'after', is_canceled, p_cancel FROM sc){_metrics('st', 'stage', 'is_canceled', 'p')}
        SELECT g AS stage, n_rows, round(pr_auc, 8) AS pr_auc, round(roc_auc, 8) AS roc_auc, round(log_loss, 8) AS log_loss,
        round(brier, 8) AS brier, round(ece, 8) AS ece FROM m""",
    "threshold_labels": f"WITH {LINES} SELECT alias, y, p >= 0.5 AS will_cancel, count(*) AS n FROM lines GROUP BY 1, 2, 3",
    "weekly_stats": f"""WITH {PRODUCTION} SELECT week, count(*) AS n_rows, round(avg(is_canceled), 4) AS cancel_rate,
        max(stay_date) + 1 AS cutoff FROM pw GROUP BY week""",
    "event_weeks": f"""WITH {EVENTS} SELECT week, count(*) AS n_rows, round(avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END), 4) AS cancel_rate,
        max(CAST(ts AS DATE)) + 1 AS cutoff FROM ev WHERE week <= 3 GROUP BY week""",
    "prior_shift": f"""WITH {PRODUCTION}, b AS (SELECT avg(is_canceled) AS r FROM sc WHERE split = 'train'),
        w AS (SELECT week, avg(is_canceled) AS c FROM pw GROUP BY week)
        SELECT week, round(r, 8) AS reference_rate, round(c, 8) AS current_rate, round(abs(c - r), 8) AS absolute_gap,
        0.05::DOUBLE AS threshold, abs(c - r) > 0.05::DOUBLE AS triggered FROM w, b""",
    "js_drift": f"""WITH {EVENT_CHUNKS}{_js('eref', 'ecur', ['value', 'user_id'])}
        SELECT week, chunk, feature, round(js_distance, 8) AS js_distance, js_distance > 0.1 AS alert FROM js""",
    "drift_alerts": f"""WITH {EVENT_CHUNKS}{_js('eref', 'ecur', ['value', 'user_id'])}
        SELECT week, count(*) FILTER (WHERE js_distance > 0.1) AS n_alerts FROM js GROUP BY week""",
    "psi_ks_drift": f"""WITH {PRODUCTION}, tr AS (SELECT * FROM sc WHERE split = 'train'),
        pc AS (SELECT *, 0 AS chunk FROM (SELECT * REPLACE (0 AS week) FROM pw)){_js('tr', 'pc', DRIFT_COLUMNS)},
        ix AS (SELECT feature, sum((greatest(q, 1e-4) - greatest(p, 1e-4)) * ln(greatest(q, 1e-4) / greatest(p, 1e-4))) AS psi FROM qs GROUP BY feature),
        v AS (SELECT feature, value, sum(r) AS r, sum(c) AS c FROM (SELECT feature, value, 1 AS r, 0 AS c FROM rl
              UNION ALL SELECT feature, value, 0, 1 FROM cl) GROUP BY 1, 2),
        f AS (SELECT feature, value, lead(value) OVER (PARTITION BY feature ORDER BY value) AS nxt,
              abs(sum(r) OVER (PARTITION BY feature ORDER BY value) / sum(r) OVER (PARTITION BY feature)
                - sum(c) OVER (PARTITION BY feature ORDER BY value) / sum(c) OVER (PARTITION BY feature)) AS gap FROM v),
        w AS (SELECT feature, max(gap) AS ks, sum(coalesce(gap * (nxt - value), 0)) AS area FROM f GROUP BY feature),
        sd AS (SELECT feature, stddev_pop(value) AS s FROM rl GROUP BY feature)
        SELECT feature, round(psi, 8) AS psi, round(ks, 8) AS ks, round(area / s, 8) AS wasserstein_normed FROM ix JOIN w USING (feature) JOIN sd USING (feature)""",
    "performance_drift": f"""WITH {DECISIONS}, b AS (SELECT pr_auc AS bp, ece AS be FROM m WHERE g = 0)
        SELECT g AS week, n_rows, round(pr_auc, 6) AS pr_auc, round(ece, 6) AS ece, round(bp, 6) AS baseline_pr_auc, round(be, 6) AS baseline_ece,
        round(bp - pr_auc, 6) AS pr_auc_drop, TRUE AS available, bp - pr_auc > 0.03::DOUBLE AS pr_auc_triggered, ece > 0.05::DOUBLE AS ece_triggered,
        bp - pr_auc > 0.03::DOUBLE OR ece > 0.05::DOUBLE AS triggered FROM m, b WHERE g > 0""",
    "retrain_decisions": f"WITH {DECISIONS} SELECT week, len(reasons) > 0 AS retrain, array_to_string(reasons, '; ') AS reasons FROM dec",
    "cooldown_actions": f"""WITH RECURSIVE {PRODUCTION}, hw AS (SELECT hotel, week, abs(avg(is_canceled) -
          (SELECT avg(is_canceled) FROM sc WHERE split = 'train')) > 0.15::DOUBLE AS signal FROM pw GROUP BY 1, 2){_fold('hw', 'hotel')}
        SELECT g AS hotel, week, action FROM fold""",
    "weekly_simulation": f"""WITH RECURSIVE {DECISIONS}, sg AS (SELECT 1 AS one, week, len(reasons) > 0 AS signal FROM dec){_fold('sg', 'one')}
        SELECT week, n_rows, round(rate, 4) AS cancel_rate, len(reasons) > 0 AS retrain_signal, array_to_string(reasons, '; ') AS reasons, action
        FROM dec JOIN fold USING (week)""",
    "promotion_gate": _gate(),
    "slo_by_path": f"""WITH {LOG}, r AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY ts DESC, id DESC) AS rn FROM log),
        l AS (SELECT path, count(*) AS count, round(quantile_cont(ms, 0.5), 2) AS p50_ms, round(quantile_cont(ms, 0.95), 2) AS p95_ms,
              round(max(ms), 2) AS max_ms FROM r WHERE rn <= 1000 GROUP BY path),
        t AS (SELECT path, count(*) AS requests FROM log GROUP BY path)
        SELECT path, requests, count, p50_ms, p95_ms, max_ms, p95_ms <= 60 AS p95_ok FROM t JOIN l USING (path)""",
    "slo_totals": f"""WITH {LOG} SELECT count(*) AS total_requests, count(*) FILTER (WHERE status BETWEEN 400 AND 499) AS client_errors_4xx,
        count(*) FILTER (WHERE status >= 500) AS server_errors_5xx, round(count(*) FILTER (WHERE status >= 500) / count(*), 4) AS error_rate,
        count(*) FILTER (WHERE status >= 500) / count(*) <= 0.01 AS error_rate_ok FROM log""",
    "recommendations": f"""WITH RECURSIVE {SCORED_BY_PROPERTY}{DAY_CAPACITY.format(source='sc')},
        hold AS (SELECT hotel, d AS stay_date, count(*) AS held FROM (
            SELECT hotel, CAST(unnest(generate_series((stay_date + 1)::TIMESTAMP, (stay_date + length_of_stay - 1)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d
            FROM sc WHERE is_canceled = 0 AND length_of_stay > 1) GROUP BY 1, 2),
        drank AS (SELECT *, row_number() OVER (PARTITION BY hotel, stay_date ORDER BY lead_time DESC, row_id) AS rn FROM sc),
        nb AS (SELECT sc.hotel, sc.stay_date, count(*) AS n, avg(adr) AS adr_ref, avg(p_cancel) AS mp, sum(1 - p_cancel) AS shows,
                      any_value(capacity) AS capacity, coalesce(any_value(held), 0) AS held,
                      greatest(0, any_value(capacity) - coalesce(any_value(held), 0)) AS free
               FROM sc JOIN dcap ON dcap.hotel = sc.hotel LEFT JOIN hold ON hold.hotel = sc.hotel AND hold.stay_date = sc.stay_date GROUP BY 1, 2)
        {LAW.format(nights='nb', ranked='drank')},
        g AS (SELECT law.hotel, law.stay_date, m, sum(prob * greatest(0, free - s)) AS e, sum(prob * greatest(0, s - free)) AS v
              FROM law JOIN nb USING (hotel, stay_date) GROUP BY 1, 2, 3),
        tried AS (SELECT nb.*, o, adr_ref * e + 2.0::DOUBLE * adr_ref * v AS cost FROM nb, range(0, 1000) t(o), g
                  WHERE o <= greatest(1, floor(0.3::DOUBLE * free)) AND g.hotel = nb.hotel AND g.stay_date = nb.stay_date AND g.m = least(n, free + o)),
        best AS (SELECT * FROM tried QUALIFY row_number() OVER (PARTITION BY hotel, stay_date ORDER BY round(cost, 5), o) = 1)
        SELECT hotel, stay_date, CAST(o AS INT) AS o_star, capacity, CAST(held AS INT) AS already_occupied, CAST(free AS INT) AS effective_capacity,
        round(cost, 2) AS expected_cost, round(adr_ref, 2) AS adr_ref, n AS n_new_bookings, round(mp, 4) AS mean_p_cancel,
        round(shows, 1) AS expected_show_ups FROM best""",
}

SQL["table_fingerprint"] = """WITH h AS (SELECT l_returnflag, CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_partkey, l_linenumber,
    CAST(round(l_extendedprice * 100) AS BIGINT), CAST(l_shipdate AS DATE), l_linestatus)), 1, 15) AS BIGINT) AS v FROM lineitem)
    SELECT l_returnflag, count(*) AS n_rows, CAST(sum(v) AS VARCHAR) AS hash_sum, bit_xor(v) AS hash_xor FROM h GROUP BY 1"""
SQL["preprocess_numeric"] = f"WITH {RAW} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(m, 4) AS median, round((SELECT avg(coalesce({c}, m)) FROM raw), 4) AS mean,
    round((SELECT stddev_pop(coalesce({c}, m)) FROM raw), 4) AS deviation FROM (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m FROM raw)"""
    for c in ["lead_time", "adr", "children", "agent", "company", "adults"]
)
SQL["preprocess_levels"] = f"""WITH {SPLIT}, lv AS (
    {' UNION ALL '.join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level, split = 'train' AS t FROM sp" for c in ['segment', 'deposit_type', 'property', 'lead_time'])}),
    c AS (SELECT feature, level, count(*) FILTER (WHERE t) AS n_train, count(*) FILTER (WHERE NOT t) AS n_rows FROM lv GROUP BY 1, 2)
    SELECT feature, level, n_rows, CASE WHEN n_train >= 5 THEN 'frequent' WHEN n_train > 0 THEN 'rare' ELSE 'unseen' END AS state FROM c WHERE n_rows > 0"""
_LEVEL_COLUMNS = {"segment": "segment", "property": "property", "lead_time": "CAST(lead_time AS VARCHAR)", "guest": "property || '-' || lead_time"}
SQL["encoded_levels"] = f"""WITH {SPLIT}, lv AS (
    {' UNION ALL '.join(f"SELECT '{f}' AS feature, {c} AS level, count(*) AS n FROM sp WHERE split = 'train' GROUP BY 2" for f, c in _LEVEL_COLUMNS.items())}),
    t AS (SELECT feature, level, CASE WHEN n >= 5 THEN row_number() OVER (PARTITION BY feature, n >= 5 ORDER BY level) - 1
                                 ELSE count(*) FILTER (WHERE n >= 5) OVER (PARTITION BY feature) END AS at FROM lv)
    SELECT row_id, {', '.join(f"{f}.at AS {f}_at" for f in _LEVEL_COLUMNS)} FROM sp
    {' '.join(f"LEFT JOIN t AS {f} ON {f}.feature = '{f}' AND {f}.level = {c.replace('property', 'sp.property').replace('lead_time', 'sp.lead_time') if f != 'segment' else 'sp.segment'}" for f, c in _LEVEL_COLUMNS.items())}
    WHERE split <> 'train'"""
_FOREST = f"""WITH {SPLIT}, nodes(tree, node, feature, threshold, lft, rgt, value, weight) AS (VALUES
    (0, 0, 0, 150000.0, 1, 2, 0.4, 1.0), (0, 1, 1, 90.0, 3, 4, 0.3, 1.0), (0, 2, -1, NULL, -1, -1, 0.7, 1.0), (0, 3, -1, NULL, -1, -1, 0.125, 1.0),
    (0, 4, 2, 6.0, 5, 6, 0.5, 1.0), (0, 5, -1, NULL, -1, -1, 0.375, 1.0), (0, 6, -1, NULL, -1, -1, 0.625, 1.0),
    (1, 0, 2, 3.0, 1, 2, 0.45, 2.0), (1, 1, -1, NULL, -1, -1, 0.25, 2.0), (1, 2, 0, 60000.0, 3, 4, 0.5, 2.0),
    (1, 3, -1, NULL, -1, -1, 0.0625, 2.0), (1, 4, -1, NULL, -1, -1, 0.875, 2.0)),
    w0 AS (SELECT row_id, is_canceled, [adr, lead_time, month(stay_date)] AS x, tree, 0 AS node FROM sp, (SELECT DISTINCT tree FROM nodes)),
    {', '.join(f"w{i + 1} AS (SELECT row_id, is_canceled, x, tree, CASE WHEN lft < 0 THEN node WHEN x[feature + 1] <= threshold THEN lft ELSE rgt END AS node FROM w{i} JOIN nodes USING (tree, node))" for i in range(3))}"""
SQL["forest_scores"] = f"{_FOREST} SELECT row_id, round(CAST(sum(value * weight) / sum(weight) AS DOUBLE), 6) AS p FROM w3 JOIN nodes USING (tree, node) GROUP BY 1"
SQL["forest_leaf_rates"] = f"""{_FOREST} SELECT tree, node, CAST(value AS DOUBLE) AS value, count(*) AS n_rows, round(avg(is_canceled), 6) AS rate
    FROM w3 JOIN nodes USING (tree, node) GROUP BY 1, 2, 3"""
SQL["logistic_gradient"] = f"""WITH {SPLIT}, g AS (SELECT is_canceled AS y, CAST(adr AS DOUBLE) / 100000 AS price, lead_time / 100.0::DOUBLE AS lead, month(stay_date) AS month FROM sp WHERE split = 'train'),
    e AS (SELECT *, 1 / (1 + exp(-(-0.4::DOUBLE + 0.2::DOUBLE * price - 0.1::DOUBLE * lead + 0.03::DOUBLE * month))) - y AS err FROM g)
    SELECT 'price' AS feature, round(avg(err * price) + 0.01 * 0.2::DOUBLE, 6) AS gradient FROM e
    UNION ALL SELECT 'lead', round(avg(err * lead) - 0.01 * 0.1::DOUBLE, 6) FROM e
    UNION ALL SELECT 'month', round(avg(err * month) + 0.01 * 0.03::DOUBLE, 6) FROM e
    UNION ALL SELECT '(intercept)', round(avg(err), 6) FROM e"""
SQL["isotonic_calibration"] = f"""WITH {SCORED}, v AS (SELECT round(p_cancel, 6) AS p, count(*) AS n, sum(is_canceled) AS y FROM sc WHERE split = 'validation' GROUP BY 1),
    o AS (SELECT p, row_number() OVER (ORDER BY p) AS i, sum(n) OVER (ORDER BY p) AS cn, sum(y) OVER (ORDER BY p) AS cy, n, y FROM v),
    s AS (SELECT a.i AS a, b.i AS b, (b.cy - a.cy + a.y)::DOUBLE / (b.cn - a.cn + a.n) AS r FROM o a JOIN o b ON b.i >= a.i),
    w AS (SELECT o.i, s.a, min(s.r) AS r FROM o JOIN s ON s.a <= o.i AND s.b >= o.i GROUP BY 1, 2)
    SELECT p AS p_raw, round((SELECT max(r) FROM w WHERE w.i = o.i), 6) AS calibrated FROM o"""
SQL["csv_two_headers"] = f"""WITH {RAW} SELECT hotel, meal, count(*) AS n, CAST(sum(adults) AS BIGINT) AS adults, CAST(sum(babies) AS BIGINT) AS babies,
    CAST(sum(lead_time) AS BIGINT) AS lead_time, count(company) FILTER (WHERE lead_time % 3 <> 2) AS n_company, max(reservation_status_date) AS last_day
    FROM raw GROUP BY 1, 2"""
SQL["csv_quoted_fields"] = """SELECT event_id, event_type, props, 'he said "' || event_type || ', y", and ""' || props || '"' AS said FROM events"""


def _text_report() -> str:
    """Counts of the unreadable cells that the query plants, and no others."""
    planted = {"children": "row_key % 101 = 5", "agent": "row_key % 103 = 7"}
    fractions = {"children": "row_key % 101 = 6"}
    whole = {f.name for f in schema.CLEAN_SCHEMA.fields if f.dataType.simpleString() in ("int", "bigint")}
    lines = [("corrupt_record", schema.CORRUPT, "row_key % 83 = 2", "{n} records with a wrong number of fields")]
    numeric = [f.name for f in schema.RAW_SCHEMA.fields if f.dataType.simpleString() in ("int", "bigint", "double")]
    for name in numeric:
        lines.append(("data_type", name, planted.get(name, "false"), "expected numeric type, {n} values are not"))
        if name in whole:
            lines.append(("data_type", name, fractions.get(name, "false"), "{n} values are not whole numbers"))
    lines.append(("date", "arrival_date", "false", "{n} invalid dates"))
    lines.append(("date", "reservation_status_date", "row_key % 89 = 3", "{n} invalid date values"))
    parts = [
        f"SELECT '{rule}' AS rule, '{column}' AS \"column\", '{column}: ' || replace('{text}', '{{n}}', CAST(n_bad AS VARCHAR)) AS message, n_bad "
        f"FROM (SELECT count(*) FILTER (WHERE {bad}) AS n_bad FROM raw)"
        for rule, column, bad, text in lines
    ]
    return f"WITH {RAW} " + " UNION ALL ".join(parts)


SQL["text_validation_report"] = _text_report()
SQL["stream_quarantine"] = SQL["quarantine"]
SQL["stream_cooldown"] = SQL["cooldown_actions"]
SQL["stream_occupancy"] = f"SELECT * FROM ({SQL['nightly_occupancy']}) WHERE occupancy > 0"
SQL["stream_active_list"] = (
    f"WITH {BOOKINGS}, stayed AS (SELECT * REPLACE (property AS hotel) FROM bk WHERE is_canceled = 0),"
    f"{OCCUPANCY.format(rows='stayed')} SELECT * FROM occ"
)
SQL["stream_weekly_stats"] = f"""WITH {EVENTS} SELECT week, count(*) AS n_rows,
    round(avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END), 6) AS cancel_rate FROM ev GROUP BY week"""
SQL["stream_late_repaired"] = SQL["stream_weekly_stats"]
SQL["stream_service_levels"] = f"""WITH {LOG} SELECT path, CAST(ts AS DATE) AS day, count(*) AS requests,
    count(*) FILTER (WHERE status >= 500) AS server_errors_5xx, quantile_disc(ms, 0.5) AS p50_ms, quantile_disc(ms, 0.95) AS p95_ms,
    max(ms) AS max_ms FROM log GROUP BY 1, 2"""
SQL["stream_sliding_levels"] = f"""WITH {LOG} SELECT path, CAST(ts AS DATE) - back AS day, count(*) AS requests,
    count(*) FILTER (WHERE status >= 500) AS server_errors_5xx, quantile_disc(ms, 0.5) AS p50_ms, quantile_disc(ms, 0.95) AS p95_ms,
    max(ms) AS max_ms FROM log, (VALUES (0), (1)) t(back) GROUP BY 1, 2"""
SQL["stream_late_labels"] = f"""WITH {SCORED}{_metrics('sc', 'hotel', 'is_canceled', 'p_cancel')}
    SELECT g AS hotel, n_rows, round(pr_auc, 6) AS pr_auc, round(ece, 6) AS ece FROM m"""


def _off_ties(text: str) -> str:
    """Shift what is rounded by a hair, so that exact ties round the same way on every engine."""
    out, at = [], 0
    while (start := text.find(" round(", at)) >= 0:
        begin = start + len(" round(")
        depth, end = 1, begin
        while depth:
            depth += {"(": 1, ")": -1}.get(text[end], 0)
            end += 1
        inner, digits = text[begin : end - 1].rsplit(",", 1)
        out += [text[at:start], f" round(({inner}) + 1e-{int(digits) + 4}::DOUBLE, {int(digits)})"]
        at = end
    return "".join(out) + text[at:]


SQL = {name: _off_ties(text) for name, text in SQL.items()}
