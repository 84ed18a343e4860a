"""Conversation repair, spelling variants and removal of repeated strings against brute force."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from roomtide.llm import repair, spelling, suffix_dedup

WHITE = " \t\n\x0b\x0c\r"

# --- op11 --------------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string, digest string, times int, first int"


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def cheapest(rows):
    """Shortest path over whole strings of edits, in order of (cost, edits)."""
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(WHITE)
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, edits, i, said, lines = heapq.heappop(queue)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", said):
            counts = [faults.count(f) for f in "bdt"]
            return (gaps, *counts, illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())
        if (i, said[-1:]) in done:
            continue
        done.add((i, said[-1:]))

        def go(role, text, letter, price, step):
            if re.fullmatch("s?(ua)*u?", said + role[:1]) and role[:1]:
                heapq.heappush(queue, (cost + price, edits + letter, i + step, said + role[0], (*lines, f"{role}:{text}")))

        for role in ("user", "assistant"):
            go(role, "", "I", 3, 0)
        if i < len(rows):
            _, own, text = rows[i]
            heapq.heappush(queue, (cost + 4, edits + "D", i + 1, said, lines))
            if faults[i] not in ("b", "d"):
                more = 3 if faults[i] == "t" else 0
                go(own, text, "K", more, 1)
                for role in ("user", "assistant"):
                    go(role, text, "R", 3 + more, 1)


def talks():
    pick, rows = random.Random(3), []
    for conv in range(150):
        for turn in range(pick.choice([1, 2, 3, 8, 25])):
            for _ in range(pick.choice([1, 1, 1, 2])):
                role = pick.choice(["user", "assistant", "system", "tool", "user", "assistant", None, ""])
                text = pick.choice(["Hi.", "ok", "  ", "What? ", "x!\n", None, "", f"T{pick.random():.2f}.", f"U{pick.random():.2f}"])
                rows.append((None if conv == 7 else conv, None if pick.random() < 0.05 else turn * pick.choice([1, 1, 2]), role, text))
    rows += [(900, t, pick.choice(["user", "assistant"]), f"m{t}.") for t in range(1500)]  # long, many rows of one role
    rows += [(901, t, "user", f"m{t}.") for t in range(400)] + [(902, t, "user", "same.") for t in range(400)]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("settle_every", [512, 3])
def test_repair_equals_shortest_path(spark, settle_every):
    rows = talks()
    df = spark.createDataFrame([(*r, "d", 1, 2) for r in rows], TURNS).repartition(3)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.damage_and_repair(df, settle_every=settle_every).collect()}
    assert got == {conv: cheapest(own) for conv, own in damaged(rows).items()}


def test_repair_of_dropped_and_empty(spark):
    df = spark.createDataFrame([(c, 0, "user", "a.", "", 1, 1) for c in range(60)], TURNS)
    got = {r["conv_id"]: r for r in repair.damage_and_repair(df).collect()}
    gone = [c for c in range(60) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert len(got) == 60 and gone
    for c in gone:
        assert tuple(got[c])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.damage_and_repair(df.limit(0)).count() == 0


def test_trails_compare_as_strings():
    pick = random.Random(1)
    trails, words = [repair.Trail(None, "")], [""]
    for _ in range(300):
        k = pick.randrange(len(trails))
        letter = pick.choice("DIK")
        if words[k] + letter not in words:  # a list of edits has one node
            trails.append(repair.Trail(trails[k], letter))
            words.append(words[k] + letter)
    for _ in range(3000):
        a, b = pick.randrange(len(words)), pick.randrange(len(words))
        assert repair.less(trails[a], trails[b]) == (words[a] < words[b])
    some = [3, len(words) // 2, len(words) - 1]
    ancestor = repair.common_ancestor([trails[k] for k in some])
    prefix = words[trails.index(ancestor)]
    assert all(words[k].startswith(prefix) for k in some)


def test_equal_hashes_are_verified():
    root = repair.Trail(None, "")
    a, b = repair.Trail(root, "D"), repair.Trail(root, "K")
    b.hash = a.hash
    assert not repair.same(a, b) and repair.less(a, b) and not repair.less(b, a)


# --- op12 --------------------------------------------------------------------

DOCS = "doc_id bigint, text string, word string, n string, cell int"


def variants(docs, every=97):
    counts = Counter()
    for doc, text in docs:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 5
    counts = {w: n for w, n in counts.items() if n >= 3}
    near, holes = {w: set() for w in counts}, {}
    for w in counts:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1 :]), []).append(w)
            if (shorter := w[:i] + w[i + 1 :]) in counts:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in holes.values():
        for w in group:
            near[w].update(o for o in group if o != w)
    forms = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-counts[o], o))
            if counts[best] >= 2 * counts[w]:
                forms[w] = best
    made = {}
    for w in counts:
        root = w
        while root in forms:
            root = forms[root]
        made[w] = (forms.get(w), root, counts[w], len(near[w]), counts[forms[w]] if w in forms else None)
    return made


@pytest.mark.parametrize("cell_words, every", [(16_384, 97), (40, 3)])
def test_spelling_variants_equal_brute_force(spark, cell_words, every):
    pick = random.Random(5)
    word = lambda: "".join(pick.choice("abéÀ×") for _ in range(pick.randint(4, 7))).title()
    docs = [(None if i == 3 else i // 2, " ".join(word() for _ in range(250))) for i in range(60)]
    docs += [(77, None), (78, ""), (79, " ".join(["z" * 3000, "z" * 3001] * 4)), (80, "1 2, -"), (5, docs[5][1]), (5, docs[5][1])]
    df = spark.createDataFrame([(*d, "w", "x", 1) for d in docs], DOCS).repartition(3)
    found = spelling.group_variants(df, spelling.Settings(every=every), cell_words=cell_words)
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found.collect()}
    want = variants(docs, every)
    assert got == want
    assert any(v[0] for v in want.values())
    assert spelling.group_variants(df.limit(0)).count() == 0


def test_tree_reaches_all_points_in_the_radius():
    pick = np.random.default_rng(2)
    vectors = pick.integers(0, 3, (600, spelling.AXES), dtype=np.uint8)
    vectors[:, 6:] = 0
    leaves = []
    root = spelling.grow(vectors, 10, leaves)
    assert sorted(np.concatenate(leaves)) == list(range(600)) and len(leaves) > 20
    apart = np.abs(vectors[:, None, :].astype(int) - vectors[None, :, :]).sum(2)
    for radius in (0, 1, 2):
        reached = np.zeros((600, 600), bool)
        for leaf, rows in spelling.reach(root, vectors, radius):
            reached[rows[:, None], leaves[leaf][None, :]] = True
        assert reached[apart <= radius].all() and not reached.all()


# --- op13 --------------------------------------------------------------------


def without_repeats(texts, length):
    bodies = [(t or "").encode() for t in texts]
    counts = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    made = []
    for b in bodies:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        made.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(made)


def test_interval_expansion_equals_brute_force():
    for seed in range(60):
        pick = random.Random(seed)
        letters, length = "ab" if seed % 2 else "abcdé", pick.choice([3, 5, 8, 20])
        base = "".join(pick.choice(letters) for _ in range(60))
        parts = []
        for _ in range(pick.randint(1, 12)):
            start = pick.randint(0, 40)
            part = base[start : start + pick.randint(length, length + 20)] + "".join(pick.choice(letters) for _ in range(pick.randint(0, 9)))
            parts.append(part.encode().ljust(length, b"a"))
        weights = np.array([pick.choice([1, 1, 2]) for _ in parts])
        counts = Counter()
        for part, n in zip(parts, weights):
            counts.update({k: int(n) * v for k, v in Counter(part[i : i + length] for i in range(len(part) - length + 1)).items()})
        for part, flags in zip(parts, suffix_dedup.repeated_starts(parts, weights, length)):
            assert list(flags) == [counts[part[i : i + length]] > 1 for i in range(len(part) - length + 1)]


@pytest.mark.parametrize("length, gram, regions_in_text", [(20, 8, 4096), (20, 8, 3), (30, 32, 5)])
def test_removal_equals_brute_force(spark, length, gram, regions_in_text):
    pick = random.Random(5)
    prose = lambda n: " ".join("".join(pick.choice("th er on an ing é".split()) for _ in range(pick.randint(1, 3))) for _ in range(n))
    passage = prose(20)
    texts = [None, "", "x" * 700, "ab" * 50, prose(5)] + [prose(pick.randint(3, 40)) + passage + prose(pick.randint(3, 40)) for _ in range(40)]
    texts += [*texts[-3:], passage, passage[5:] + prose(30)]
    ids = [None if i == 3 else i // 2 for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, "a", 1, 2) for i, t in zip(ids, texts)], "doc_id bigint, text string, anchor string, shard int, mask int").repartition(3)
    made = suffix_dedup.remove_repeats(spark, df, length, gram=gram, regions_in_text=regions_in_text).collect()
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in made) == without_repeats(texts, length)
    assert sorted(r["doc_id"] for r in made if r["doc_id"] is not None) == sorted(i for i in ids if i is not None)
    assert suffix_dedup.remove_repeats(spark, df.limit(0), length).count() == 0


def test_regions_cover_every_string_once(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 37)
    pick = random.Random(9)
    bodies = ["".join(pick.choice("ab") for _ in range(pick.randint(0, 90))).encode() for _ in range(12)] + [b"q" * 80]
    bounds = np.cumsum([0, *map(len, bodies)])
    doc, start, number, anchor = suffix_dedup.regions_of(np.frombuffer(b"".join(bodies), np.uint8), bounds, 20, 6)
    starts = [s + k for s, n in zip(start, number) for k in range(n)]
    assert sorted(starts) == [b + k for b, body in zip(bounds, bodies) for k in range(len(body) - 19)]
    anchors = {}
    whole = b"".join(bodies)
    for s, n, a in zip(start, number, anchor):
        for k in range(n):
            assert anchors.setdefault(whole[s + k : s + k + 20], a) == a
