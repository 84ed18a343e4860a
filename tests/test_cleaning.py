from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import booking, three_bookings
from roomtide.operators import cleaning


def large():
    return three_bookings() * 100


def test_bad_rows_go_and_missing_price_stays(make_raw):
    rows = large()
    rows[0] = booking(adr=-10.0)
    rows[1] = booking(adults=0, children=None, babies=0)
    rows[2] = booking(adr=None)
    kept = cleaning.clean(make_raw(rows), "seq")
    assert kept.count() == 298
    assert kept.filter("adr is null").count() == 1


def test_row_id_and_dates(make_raw):
    found = cleaning.clean(make_raw(three_bookings()), "seq").orderBy("row_id").collect()
    assert [r.row_id for r in found] == [0, 1, 2]
    assert (found[0].arrival_date, found[0].booking_date) == (date(2016, 7, 4), date(2016, 6, 24))
    assert not any(r.is_duplicate for r in found)


def test_every_copy_is_flagged_and_nulls_agree(make_raw):
    rows = [*three_bookings(), three_bookings()[0]]
    found = cleaning.flag_duplicates(make_raw(rows)).orderBy("seq").collect()
    assert [r.is_duplicate for r in found] == [True, False, False, True]
    totals = cleaning.duplicate_totals(make_raw(rows)).first()
    assert (totals.all_members, totals.extra_copies) == (2, 1)


def test_flags_before_removal(make_raw):
    rows = [*large(), booking(adr=-1.0), booking(adr=-1.0)]
    assert cleaning.clean(make_raw(rows), "seq").count() == 300


def test_hot_copies_keep_every_row(make_raw):
    times = F.when(F.col("seq") == 0, 5001).otherwise(1)
    rows = make_raw(three_bookings()).withColumn("copy", F.explode(F.sequence(F.lit(1), times)))
    flagged = cleaning.flag_duplicates(rows)
    assert flagged.count() == 5003
    assert flagged.filter("is_duplicate").count() == 5001


def test_removal_gate(make_raw):
    rows = three_bookings()
    rows[0] = booking(adr=-10.0)
    with pytest.raises(cleaning.RemovalGateError, match="33.33%"):
        cleaning.clean(make_raw(rows), "seq")
    with pytest.raises(cleaning.RemovalGateError, match="empty"):
        cleaning.check_removal(make_raw([]))
    exactly_one_percent = large()[:99] + [booking(adr=-10.0)]
    cleaning.check_removal(make_raw(exactly_one_percent))


def test_flip_first_labels(make_raw):
    found = cleaning.flip_first_labels(make_raw([booking()] * 7), "seq").orderBy("seq").collect()
    assert [r.is_canceled for r in found] == [1, 1, 0, 0, 0, 0, 0]
