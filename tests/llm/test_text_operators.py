"""The operators against brute force, on small tables with every awkward case."""

import base64
import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Column
from pyspark.sql import functions as F

from roomtide.llm import context_tree, html_text, minhash, near_groups, packing, quality, simhash, snapshots, spaced_seeds, token_files, warc
from roomtide.llm.common import least_difference, parity

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, fp string, key int"


def as_docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", len(t or ""), "x", "y", 1) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(seed, n, words=400):
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("th er on an ing ed ble".split()) for _ in range(pick.randint(1, 4))) for _ in range(n)) if words else ""


def edited(text, seed, share):
    pick, words = random.Random(seed), text.split()
    for k in pick.sample(range(len(words)), max(1, int(share * len(words)))):
        words[k] = f"new{pick.randint(0, 10**6)}"
    return " ".join(words)


AWKWARD = [None, "", "  \n ", "One", "one two", "a b c", "a b c", "É ü ß", "x" * 5000, prose(1, 3000)]


@pytest.fixture(scope="module")
def mixed(spark):
    base = [prose(s, 200) for s in range(6)]
    texts = AWKWARD + base + [edited(b, 7, 0.01) for b in base] + [base[0], base[0]]
    return as_docs(spark, texts, [*range(len(texts) - 1), 10]), texts


# --- op1 ---------------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string, place int"


def test_snapshots_keep_maximal_conversations(spark):
    talk = lambda c, *said: [(c, i, "user" if i % 2 == 0 else "assistant", s, 0) for i, s in enumerate(said)]
    rows = talk(1, "a", "b") + talk(2, "a", "b", "c") + talk(3, "a", "x") + talk(4, "a", "x") + talk(5, "b", "a") + talk(6, None) + talk(7, "a")
    rows += [(None, 0, "user", "q", 0), (8, None, None, "z", 0), (8, None, None, "z", 0)]
    found = {r["conv_id"]: r for r in snapshots.collapse_and_render(spark.createDataFrame(rows, TURNS)).collect()}
    assert set(found) == {2, 3, 5, 6, 8, None}
    assert (found[3]["n_copies"], found[2]["n_turns"], found[8]["n_turns"]) == (2, 3, 1)
    assert found[5]["text"] == "<|im_start|>user\nb<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"
    assert found[6]["text"] == "<|im_start|>user\n<|im_end|>\n"


def test_snapshots_run_no_python(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a", 0)], TURNS)
    plan = snapshots.collapse_and_render(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert snapshots.collapse_and_render(rows.limit(0)).count() == 0


# --- op2 ---------------------------------------------------------------------


def test_archives_round_trip(spark):
    pages = [(i, f"http://www.A{i % 3}.example.org/p?q={i}", f"<p>{i % 4}</p>") for i in range(40)]
    pages += [(40, None, None), (41, "not a url\r\nX: y", ""), (42, "http://é.org", "é\r\n\r\n"), (None, "http://n.org/", "only"), (43, "http://z.org", "<p>1</p>")]
    df = spark.createDataFrame([(*p, "d", 1) for p in pages], "page_id bigint, url string, html string, digest string, run int").repartition(5)
    got = {r["page_id"]: r for r in warc.archive_and_index(spark, df).collect()}
    assert len(got) == len(pages)
    newest = {}
    for i, _, body in pages:
        newest[body or ""] = max(newest.get(body or "", -1), -1 if i is None else i)
    for i, _, body in pages:
        data, last = (body or "").encode(), newest[body or ""]
        revisit = i is not None and i != last
        want = (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", last if revisit else None)
        assert (got[i]["payload_bytes"], got[i]["payload_digest"], got[i]["record_type"], got[i]["refers_to"]) == want
    assert sorted(r["index_rank"] for r in got.values()) == list(range(len(pages)))
    ordered = sorted(got.values(), key=lambda r: r["index_rank"])
    assert [r["url_key"] for r in ordered] == sorted(r["url_key"] for r in ordered)
    assert got[0]["url_key"] == "org,example,a0)/p?q=0"
    assert warc.archive_and_index(spark, df.limit(0)).count() == 0


def test_loser_tree_merges():
    for k in range(0, 9):
        runs = [sorted(random.Random(k * 10 + j).choices(range(50), k=j * 3)) for j in range(k)]
        merged = [x[0] for x in warc.LoserTree([iter([(v,) for v in run]) for run in runs])]
        assert merged == sorted(itertools.chain(*runs))


# --- op3 ---------------------------------------------------------------------


def test_bucket_boundaries_are_optimal():
    pick = np.random.default_rng(3)
    for _ in range(15):
        lengths = np.unique(pick.integers(1, 60, 9)).astype(np.int64)
        counts = pick.integers(1, 9, len(lengths)).astype(np.int64)
        cost = lambda ends: sum(n * (min(e for e in ends if e >= x) - x) for x, n in zip(lengths, counts))
        for k in (1, 2, 3, 12):
            best = min(cost({*c, lengths[-1]}) for c in itertools.combinations(lengths, min(k, len(lengths)) - 1))
            ends = packing.boundaries(lengths, counts, k)
            assert len(ends) <= k and cost(ends) == best
    assert packing.boundaries(np.zeros(0, np.int64), np.zeros(0, np.int64), 3) == []


def test_packing_keeps_every_token(spark, mixed):
    docs, texts = mixed
    plan = packing.Settings(max_length=64, buckets=4, budget=256, block_rows=7)
    rows = packing.pack(docs, settings=plan).collect()
    total = sum(len((t or "").split()) + 1 for t in texts)
    assert sum(r["length"] for r in rows) == total
    for (padded, _), group in itertools.groupby(sorted(rows, key=lambda r: (r["padded"], r["batch"])), key=lambda r: (r["padded"], r["batch"])):
        group = list(group)
        assert all(r["length"] <= padded for r in group) and len(group) * padded <= 256
        assert sorted(r["slot"] for r in group) == list(range(len(group)))
    assert {tuple(r) for r in rows} == {tuple(r) for r in packing.pack(docs, settings=packing.Settings(64, 4, 256)).collect()}
    assert packing.pack(docs.limit(0)).count() == 0


# --- op4 ---------------------------------------------------------------------


def test_quality_learns_from_positives(spark):
    pick = random.Random(5)
    texts, marks = [], []
    for i in range(400):
        good = pick.random() < 0.7
        words = prose(i + 50, 60)
        texts.append(words if good else pick.choice([words.upper().replace(" ", "!! "), " | ".join(words.split()), " ".join(w for w in words.split()[:5] for _ in range(12))]))
        marks.append((i, int(good)))
    docs = as_docs(spark, texts + [None, ""], [*range(400), 400, None])
    labels = spark.createDataFrame([*marks, (3, None), (None, 1), (9999, 1)], "doc_id bigint, quality int")
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == 402 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 400]
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) == r["held_out"] for r in rows if r["doc_id"] is not None)
    assert np.mean([r["predicted"] == marks[r["doc_id"]][1] for r in held]) > 0.95
    assert {r["score"] for r in quality.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), labels).count() == 0


def test_negative_risk_never_runs_away():
    pick = np.random.default_rng(1)
    positive = np.column_stack((np.ones(20), pick.normal(2, 1, (20, 30))))
    unlabelled = np.column_stack((np.ones(40), np.concatenate((pick.normal(2, 1, (20, 30)), pick.normal(-2, 1, (20, 30))))))
    weights = quality.fit(positive, unlabelled, 0.5, quality.Settings())
    assert np.isfinite(weights).all()
    assert (quality.sigmoid(unlabelled @ weights)[:20] > 0.5).all() and (quality.sigmoid(unlabelled @ weights)[20:] < 0.5).all()


# --- op5 ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


ODD_TEXTS = ["a  b", " lead", "trail ", "a\n\nb", "a \nb", "a\tb\r\nc", "don't 's ''s", "x<|endoftext|>y", "1,234.5 € é z w", "a\x1cb", "\n", " "]


def test_pieces_equal_the_library(vocabulary):
    from tokenizers import Tokenizer

    made, library = token_files.Encoder(vocabulary), Tokenizer.from_file(vocabulary)
    for text in [*ODD_TEXTS, *(t or "" for t in AWKWARD), "Foo, bar.\nBaz!! it's 12%%% (x) _y_ – “q”", "rock'n' it's, x'., a'!! ½. ²; é.. 中。 _. ., a_", prose(5, 2000)]:
        assert np.frombuffer(made.encode(text), "<u2").tolist() == library.encode(text, add_special_tokens=False).ids


def test_all_white_space_is_known():
    for c in map(chr, range(0x110000)):
        if c.isspace():
            assert token_files.single_spaced(f"a{c}b") == (c in " \n") and not token_files.single_spaced(f"a{c}")


def test_token_files_round_trip(spark, vocabulary):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary)
    texts = [*ODD_TEXTS, *AWKWARD]
    ids = [None, *range(3, len(texts) + 1), 7]
    docs = as_docs(spark, [*texts, "again"], ids).repartition(4)
    rows = token_files.encode_and_read(spark, docs, vocabulary, 2).collect()
    start, want = 0, Counter()
    order = sorted(zip(ids, [*texts, "again"]), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for i, text in order:
        found = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want[i, start, len(found), zlib.crc32(np.array(found, "<u4").tobytes())] += 1
        start += len(found)
    assert Counter(tuple(r) for r in rows) == want
    assert token_files.encode_and_read(spark, docs.limit(0), vocabulary, 2).count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 5000])
def test_perfect_hash_is_minimal(n):
    keys = token_files.key_hash(np.arange(n, dtype=np.int64), np.zeros(n, np.int64))
    shift, slots = token_files.perfect_hash(keys)
    assert sorted(slots) == list(range(n))
    assert (token_files.slot_of(keys, shift[token_files.bucket_of(keys, len(shift))], n) == slots).all()


def test_unknown_keys_are_not_found(spark, vocabulary):
    docs = as_docs(spark, ["a", "b"], [1, 2])
    rows = token_files.write_shards(docs, vocabulary, 2, token_files.new_folder(spark, "shards"))
    index = token_files.build_index(rows, 1)
    asked = spark.createDataFrame([(1, 0), (2, 1), (77, 0)], "doc_id bigint, occurrence bigint")
    assert [r["doc_id"] for r in token_files.look_up(asked, index, 1).collect()] == [1]


# --- op6 ---------------------------------------------------------------------


def test_fingerprints_of_neighbours(spark, mixed):
    docs, texts = mixed
    ids = [*range(len(texts) - 1), 10]
    got = minhash.fingerprints(docs.repartition(5)).collect()
    order = sorted(zip(ids, texts), key=lambda r: (-r[0], hashlib.md5((r[1] or "").encode()).digest()))
    want, seen = Counter(), {}
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        want[i, len(text), hashlib.sha256((text[: len(text) - cut] + after[:cut]).encode()).hexdigest()] += 1
        seen[i, len(text)] = text
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    prints = {}
    for r in got:
        assert prints.setdefault(seen[r["doc_id"], r["n_chars"]], r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert minhash.fingerprints(docs.limit(0)).count() == 0
    one = minhash.fingerprints(docs.where("doc_id = 9")).first()
    assert one["near_next"] == 1.0


def brute_groups(texts, width, likeness):
    sets = [{tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if (w := (t or "").lower().split()) else set() for t in texts]
    label = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        union = len(sets[a] | sets[b])
        if (len(sets[a] & sets[b]) / union if union else 1.0) >= likeness:
            low, high = sorted((label[a], label[b]))
            label = [low if x == high else x for x in label]
    return label


def test_minhash_classes_equal_brute_force(spark):
    base = [prose(s, 150) for s in range(8)]
    texts = [*base, *(edited(b, 3, 0.02) for b in base), *(edited(b, 4, 0.2) for b in base), base[2], base[2], None, "", "one", "one"]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(as_docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_groups(texts, 5, 0.8)


def test_minhash_classes_of_hundreds_of_texts_and_chains(spark):
    base = prose(3, 120).split()
    slid = [" ".join(base[k : k + 60] + [f"w{k}"]) for k in range(0, 60, 3)]  # each is alike to its neighbours only
    texts = slid[::2] + slid[1::2] + [edited(prose(4, 300), s, 0.004) for s in range(400)] + ["", " \t", None]
    want = brute_groups(texts, 5, 0.8)
    got = {r["doc_id"]: r for r in minhash.fingerprints_and_classes(as_docs(spark, texts)).collect()}
    assert [got[i]["class_id"] for i in range(len(texts))] == want
    for label, members in itertools.groupby(sorted(range(len(texts)), key=want.__getitem__), want.__getitem__):
        members = list(members)
        assert {got[i]["class_texts"] for i in members} == {len({texts[i] or "" for i in members})}


def test_minhash_finds_every_twin_of_a_crowd(spark, twins=40):
    texts = crowd(twins)  # all share a long passage, each has one near copy
    first = {}
    for i, text in enumerate(texts):
        first.setdefault(next(w for w in text.split() if w.startswith("own")), i)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(as_docs(spark, texts)).collect()}
    assert set(got.values()) == set(first.values()) and len(set(got.values())) == twins


def test_minhash_meets_few_pairs_in_a_group_of_near_copies(spark, monkeypatch):
    # copies are alike to what they were made from, hardly any two of them to each other
    base, met, docs = prose(6, 300), [], as_docs(spark, [])
    texts = [edited(base, s, 0.02) for s in range(120)] + [edited(base, s, 0.06) for s in range(500, 530)] + [base]
    join = type(docs).join

    def counted(self, other, on=None, how=None):
        out = join(self, other, on, how)
        if isinstance(on, Column):  # pairs that meet, before any is refuted; other joins are by names
            met.append(out.count())
        return out

    monkeypatch.setattr(type(docs), "join", counted)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(as_docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_groups(texts, 5, 0.8)
    assert sum(met) <= 5 * len(texts), met


def test_minhash_classes_without_ids_and_of_repeated_ids(spark):
    long = prose(5, 200)
    docs = as_docs(spark, [long, edited(long, 1, 0.005), long, "else", "other words", "other words"], [None, 7, 7, 7, None, None])
    docs = docs.withColumns({"digest": F.lit("x"), "id": F.lit("y"), "class_id": F.lit("z"), "size": F.lit(1.5), "print": F.lit(0)})
    got = sorted((r["doc_id"] is None, r["n_chars"], r["class_id"], r["class_texts"]) for r in minhash.fingerprints_and_classes(docs).where("n_chars > 20").collect())
    assert {g[2:] for g in got} == {(7, 2)} and len(got) == 3
    rest = minhash.fingerprints_and_classes(docs).where("n_chars < 20").collect()
    assert sorted((r["doc_id"] or 0, r["class_id"] or 0, r["class_texts"]) for r in rest) == [(0, 0, 1), (0, 0, 1), (7, 7, 1)]
    assert minhash.fingerprints_and_classes(docs.limit(0)).count() == 0


# --- op7 ---------------------------------------------------------------------


def plain_print(text):
    import xxhash

    words = bytes((text or ""), "utf-8").translate(simhash.LOWER).split()
    parts = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components_equal_brute_force(spark, mixed):
    docs, texts = mixed
    ids = [*range(len(texts) - 1), 10]
    prints = [plain_print(t) for t in texts]
    label = {p: i for p, i in sorted(zip(prints, ids), key=lambda r: -r[1])}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(label, 2):
            if bin(a ^ b).count("1") <= 2 and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    got = Counter(tuple(r) for r in simhash.simhash_components(docs).select("doc_id", "fingerprint", "component_id").collect())
    assert got == Counter((i, f"{p:016x}", label[p]) for i, p in zip(ids, prints))
    assert simhash.simhash_components(docs.limit(0)).count() == 0


def test_links_of_two_bits_and_long_chains(spark):
    pick = random.Random(2)
    chain = [pick.getrandbits(64)]
    for _ in range(60):
        a, b = pick.sample(range(64), 2)
        chain.append(chain[-1] ^ 1 << a ^ 1 << b)
    lone = [pick.getrandbits(64) for _ in range(200)]
    far = [lone[0] ^ 0b111]
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in {*chain, *lone, *far}]
    nodes = {r["node"]: r["label"] for r in simhash.linked_fingerprints(spark.createDataFrame(signed, "fp bigint")).collect()}
    assert len(nodes) == len(set(chain)) - 1 and len(set(nodes.values())) == 1


def test_golay_code_is_perfect():
    tables = simhash.golay_tables()
    words = np.random.default_rng(0).integers(0, 1 << 23, 300).astype(np.uint32)
    index = simhash.golay_index(words, tables)
    for word, i in zip(words.tolist(), index.tolist()):
        code = int(tables[0][(i << 11) & 4095] ^ tables[1][i >> 1]) | i << 11
        assert bin(word ^ code).count("1") <= 3


def test_near_groups_keep_one_of_each(spark):
    base = [prose(s, 300) for s in range(10)]
    texts = [*base, *(edited(b, 9, 0.004) for b in base), *(edited(b, 8, 0.4) for b in base), base[1], None, "", "short one", "short two"]
    docs = as_docs(spark, [*texts, base[3], "no id", "no id"], [*range(len(texts)), 3, None, None])
    kept = near_groups.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    want = {*range(10), *range(20, 30), 31, 33, 34, None}
    assert Counter(ids) == Counter(want)
    assert near_groups.keep_one(docs.limit(0)).count() == 0


def crowd(twins, seed=5):
    """Pairs of likeness 0.9 or more among texts that share five sixths of their words."""
    pick = random.Random(seed)
    common = prose(seed, 300)
    texts = []
    for i in range(twins):
        own = " ".join(f"own{i}x{k}" for k in range(60))
        texts += [f"{common} {own}", f"{common} {own} {pick.randint(0, 10**9)} end{i}"]
    pick.shuffle(texts)
    return texts


@pytest.mark.parametrize("twins", [30, 300])
def test_near_groups_find_every_twin_of_a_crowd(spark, twins):
    texts = crowd(twins)
    kept = {r["doc_id"] for r in near_groups.keep_one(as_docs(spark, texts)).collect()}
    first = {}
    for i, text in enumerate(texts):
        first.setdefault(next(w for w in text.split() if w.startswith("own")), i)
    assert kept == set(first.values()) and len(kept) == twins


def test_near_groups_of_several_hundred_and_chains_equal_brute_force(spark):
    base = prose(3, 120).split()
    slid = [" ".join(base[k : k + 60] + [f"w{k}"]) for k in range(0, 60, 3)]  # each is alike to its neighbours only
    texts = slid[::2] + slid[1::2] + [edited(prose(4, 300), s, 0.004) for s in range(200)]
    kept = {r["doc_id"] for r in near_groups.keep_one(as_docs(spark, texts)).collect()}
    assert kept == set(brute_groups(texts, 5, 0.8))


def test_near_groups_decide_by_the_sets(spark):
    texts = []
    for s in range(60):
        words = [f"t{s}n{k}" for k in range(300)]
        # one changed run spoils its shingles only: likeness from 0.75 to 0.85 in steps below 0.002
        gone = 25 + s
        texts += [" ".join(words), " ".join(words[: 300 - gone] + ([f"u{s}n{k}" for k in range(gone)] if s % 2 else []))]
    kept = {r["doc_id"] for r in near_groups.keep_one(as_docs(spark, texts)).collect()}
    assert kept == set(brute_groups(texts, 5, 0.8))


# --- op8 ---------------------------------------------------------------------


def plain_tree(streams, depth=context_tree.DEPTH):
    """Counts and weighted probabilities of every node over the running bytes of (text, weight), by dictionaries."""
    from math import lgamma, log, pi

    counts = {}
    for stream, n in streams:
        data = b"\0" * depth + stream
        for j in range(depth, len(data)):
            for d in range(depth + 1):
                for k in range(8):
                    node = (data[j - d : j], 1 << k | data[j] >> (8 - k))
                    counts.setdefault(node, [0, 0])[data[j] >> (7 - k) & 1] += n
    pe = {node: lgamma(a + 0.5) + lgamma(b + 0.5) - lgamma(a + b + 1) - log(pi) for node, (a, b) in counts.items()}
    pw, longer = {}, {}
    for node in sorted(counts, key=lambda x: -len(x[0])):
        context, place = node
        pw[node] = pe[node] if len(context) == depth else np.logaddexp(pe[node], longer[node]) - log(2)
        if context:
            up = (context[1:], place)
            longer[up] = longer.get(up, 0.0) + pw[node]
    return counts, pe, pw


def plain_log10(stream, tree, depth=context_tree.DEPTH):
    counts, pe, pw = tree
    data, total = b"\0" * depth + stream, 0.0
    for j in range(depth, len(data)):
        for k in range(8):
            place, bit, chance = 1 << k | data[j] >> (8 - k), data[j] >> (7 - k) & 1, None
            for d in range(depth, -1, -1):
                node = (data[j - d : j], place)
                a = counts.get(node, [0, 0])
                own = (a[bit] + 0.5) / (sum(a) + 1)
                share = 0.5 if node not in pe else np.exp(pe[node] - np.log(2) - pw[node])
                chance = own if chance is None else share * own + (1 - share) * chance
            total += np.log10(chance)
    return total


def test_parities_never_refute_sets_that_are_alike():
    pick = np.random.default_rng(5)
    for n in (0, 1, 5, 300, 5000):
        one = pick.integers(0, 1 << 63, n, dtype=np.uint64)
        for changed in (0, n // 20, n // 10, n // 3, n):
            two = np.concatenate([one[changed:], pick.integers(0, 1 << 63, changed + n // 8, dtype=np.uint64)])
            left, right = set(one.tolist()), set(two.tolist())
            bound = least_difference(parity(np.array(sorted(left), np.uint64)), parity(np.array(sorted(right), np.uint64)))
            assert bound <= len(left ^ right) and bound == least_difference(parity(two), parity(one))
    far = [pick.integers(0, 1 << 63, 300, dtype=np.uint64) for _ in range(2)]
    assert 9 * least_difference(*map(parity, far)) > 600  # unlike ones are refuted


def test_windows_of_long_texts_need_little_memory():
    import tracemalloc

    stream = np.random.default_rng(3).bytes(6 << 20)
    tracemalloc.start()
    sizes = [len(codes) for _, codes in context_tree.windows([b"ab", stream, b"", b"c"])]
    counting = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    sizes_scored = [len(codes) for _, codes in context_tree.windows([b"ab", stream], context_tree.SCORED_BYTES)]
    scoring = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) == len(stream) + 3 and sum(sizes_scored) == len(stream) + 2
    assert counting < 100 << 20 and scoring < 40 << 20


@pytest.mark.parametrize("small", [False, True])
def test_context_tree_scores_equal_brute_force(spark, monkeypatch, small):
    texts = ["the cat sat on the mat", "The dog sat", None, "", "a zebra é\0", "the the the cat " * 5, "unknownword the", "cat", "so the cat sat"]
    train = Counter()
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    assert any(held) and not all(held)
    spelled = [context_tree.words_of(t) + [b"\n"] for t in texts]
    for words, out in zip(spelled, held):
        if not out:
            train.update(words)
    tree = plain_tree([(b" ".join(words), int(not out)) for words, out in zip(spelled, held)])
    n, v = sum(train.values()), len(train)
    monkeypatch.setattr(context_tree, "TOP_WORDS", 3)
    monkeypatch.setattr(context_tree, "TOP_WINDOWS", 30)  # most windows meet the table of all
    if small:  # texts cut into slices, windows handed on early, trees grown a context at a time
        for name, size in (("HELD_BYTES", 7), ("HELD_WINDOWS", 5), ("GROWN_WINDOWS", 2)):
            monkeypatch.setattr(context_tree, name, size)
    got = {r["doc_id"]: r for r in context_tree.score_documents(as_docs(spark, texts)).collect()}
    for i, words in enumerate(spelled):
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(words), sum(train[w] > 0 for w in words), n)
        assert r["base_score"] == pytest.approx(sum(np.log10((train[w] + 1) / (n + v + 1)) for w in words))
        assert r["score"] == pytest.approx(plain_log10(b" ".join(words), tree))
    assert context_tree.score_documents(as_docs(spark, texts).limit(0)).count() == 0


def test_known_windows_find_all_or_say_so():
    codes = np.random.default_rng(1).choice(1 << 40, 5000, replace=False).astype(np.uint64)
    scores = np.arange(1, 5001, dtype=np.float64)
    known = context_tree.KnownWindows(codes[:4000], scores[:4000])
    found, left = known.find(codes)
    met = np.setdiff1d(np.arange(5000), left)
    assert (found[met] == scores[met]).all() and (found[left] == 0).all() and (left >= 4000).sum() == 1000 and len(met) > 3800


def test_shuffled_texts_score_lower(spark):
    """The context crosses blanks: the same words in another order are less likely."""
    import random

    rng = random.Random(5)
    nouns, verbs = ["cat", "dog", "bird", "horse", "mouse"], ["sees", "hears", "likes", "finds"]
    phrase = lambda: f"the {rng.choice(nouns)} {rng.choice(verbs)} a {rng.choice(nouns)} in the old garden"
    texts = [" and ".join(phrase() for _ in range(12)) for _ in range(60)]
    mixed = [" ".join(rng.sample(t.split(), len(t.split()))) for t in texts]
    rows = [(i, t) for i, t in enumerate(texts)]
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    other = [k for k in range(1000, 9000) if zlib.crc32(str(k).encode()) % 7 == 2][: len(held)]
    rows += [(k, mixed[i]) for k, i in zip(other, held)]
    got = {r["doc_id"]: r for r in context_tree.score_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(held) > 3
    for k, i in zip(other, held):
        assert got[i]["base_score"] == pytest.approx(got[k]["base_score"])  # the base does not see the order
        assert got[i]["score"] > got[k]["score"] + 50


def test_probabilities_of_the_next_byte_sum_to_one():
    tree = plain_tree([(b"ab a\n", 5), (b"b ab\n", 2)])
    assert sum(10 ** (plain_log10(b"ab" + bytes([c]), tree) - plain_log10(b"ab", tree)) for c in range(256)) == pytest.approx(1)


# --- op9 ---------------------------------------------------------------------

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header><p>Site, name.</p></header>'
    '<nav><ul><li><a href="/a">Home</a></ul></nav><div class="cookie-notice"><p>We use cookies, sorry.</p></div><article><h1>Head &amp; tail</h1>'
    "<p><b>First  line,\n still.<br><p>Second &lt;p&gt;, <span class='ad'>Buy</span>end.</p><div class=\"ad\">Buy now, now.</div><p></p>"
    "<ul><li>One, two.<li>Three</ul><form><p>Mail, please.</p></form></article><aside><p>Also read, this.</p></aside>"
    '<section id="comments"><p>Great text, I agree, truly.</p></section><footer>&copy; us, all.</footer></body></html>'
)


def test_main_text():
    assert html_text.main_text(PAGE) == "Head & tail\nFirst line, still.\nSecond <p>, end.\nOne, two.\nThree"
    unnamed = '<body><div><a href=x>Home</a> <a href=y>News</a></div><div><h2>Title</h2><p>A long text, with marks. And more, yes.</p><p>Short.</p></div></body>'
    assert html_text.main_text(unnamed) == "Title\nA long text, with marks. And more, yes.\nShort."
    for nothing in (None, "", "<", "<p>", "<script>x", "<!-- x", "<nav>menu</nav>"):
        assert html_text.main_text(nothing) == "" or nothing == "<"
    assert html_text.main_text("plain") == "plain"
    assert html_text.main_text('<p a="' * 2000) is not None  # an open quote must not cost quadratic time


def test_names_that_tell_of_other_parts_keep_the_text():
    body = "<p>A long text, with marks. And more, yes, of it.</p><p>Then more of it, as long, with marks. So it ends.</p>"
    want = "A long text, with marks. And more, yes, of it.\nThen more of it, as long, with marks. So it ends."
    for name in ("content with-sidebar", "has-comments", "search-results", "no-widget", "sidebar", "widget content"):
        assert html_text.main_text(f'<body><div class="{name}">{body}</div><div class="sidebar-left">Other things.</div></body>') == want
    talk = '<div class="comments">' + "<p>Somebody says this, and that. And more.</p>" * 9 + "</div>"
    assert html_text.main_text(f"<body><article>{body}</article>{talk}</body>") == want


def test_closing_section_beside_the_holder_stays():
    line = "<p>A long line of text, with marks, that goes on. And on, as it should.</p>"
    page = f"<body><div><div>{line * 19}</div></div><div><div><p>The end, closing it all, with marks, that goes on. And on.</p></div></div></body>"
    assert html_text.main_text(page).endswith("\nThe end, closing it all, with marks, that goes on. And on.")


def test_extract_keeps_rows(spark):
    rows = [(1, "u", PAGE, 5), (1, "u", PAGE, 5), (2, None, None, 6), (None, "v", "<p>é</p>", 7)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")).collect()
    assert Counter((r["page_id"], r["n_chars"] == len(r["text"])) for r in got) == Counter({(1, True): 2, (2, True): 1, (None, True): 1})


# --- op10 --------------------------------------------------------------------


def test_masks_hit_every_window_with_two_substitutions():
    for lost in itertools.combinations(range(spaced_seeds.WINDOW), 2):
        places = [{at + m for m in mask} for mask in spaced_seeds.MASKS for at in range(spaced_seeds.WINDOW - mask[-1])]
        assert any(not set(lost) & p for p in places)


def plain_leaks(docs, items):
    import re

    split = lambda t: [w for w in re.split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (t or "").lower()) if w]
    found = set()
    for (i, d), (j, b) in itertools.product(docs, items):
        a, b = split(d), split(b)
        width, need = (12, 10) if len(b) >= 12 else (len(b), len(b))
        if len(b) >= 7 and any(
            sum(x == y for x, y in zip(a[p : p + width], b[q : q + width])) >= need for p in range(len(a) - width + 1) for q in range(len(b) - width + 1)
        ):
            found.add((i, j))
    return found


def test_leaks_equal_brute_force(spark):
    items = [(0, prose(900, 40)), (1, prose(901, 15)), (2, prose(902, 8)), (3, prose(903, 5)), (4, None), (4, prose(904, 20)), (5, prose(900, 40))]
    pick, docs = random.Random(4), []
    for i in range(40):
        words, item = prose(i + 300, 80).split(), items[i % len(items)][1] or ""
        planted = item.split()[: pick.choice([9, 12, 14, 40])]
        for k in pick.sample(range(len(planted)), min(len(planted), pick.choice([0, 1, 2, 4]))):
            planted[k] = "swap"
        docs.append((i, " ".join(words[:30] + planted + words[30:])))
    docs += [(100, items[0][1].upper().replace(" ", ", ")), (101, items[2][1]), (102, None), (102, ""), (None, items[1][1]), (103, items[3][1])]
    frame = as_docs(spark, [t for _, t in docs], [i for i, _ in docs])
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, seed string")
    rows = spaced_seeds.find_leaks(frame, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == plain_leaks(docs, items) and len(rows) == len({(r[0], r[1]) for r in rows})
    assert all(r["n_equal"] <= r["n_tokens"] for r in rows)
    assert spaced_seeds.find_leaks(frame, bench.limit(0)).count() == 0 and spaced_seeds.find_leaks(frame.limit(0), bench).count() == 0


def test_a_full_bitmap_changes_nothing(spark):
    items = spark.createDataFrame([(1, prose(1, 30))], "item_id bigint, text string")
    docs = as_docs(spark, [prose(2, 50), "x " + prose(1, 30)])
    tests = spaced_seeds.item_rows(items)
    everything = np.full(1 << spaced_seeds.BITS - 3, 255, np.uint8)
    passed = spaced_seeds.segments(docs, everything)
    assert passed.count() == 2
    assert [r["doc_id"] for r in spaced_seeds.find_leaks(docs, items).collect()] == [1]
    assert tests.count() == 1 and F.col("x") is not None
