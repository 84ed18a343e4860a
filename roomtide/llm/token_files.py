"""Token-id files with a minimal perfect hash index.

Rows are dealt to ranges of the document id and sorted, and each task encodes its range and
writes one shard: header, then the ids of all documents as little-endian integers of two bytes
(four where the vocabulary needs them). The index is a table of segments. A key goes to a
segment by hash; inside it a minimal perfect hash (displacement per bucket, built in numpy)
gives each key its own slot, with a fingerprint, the shard, the offset and the length. A
lookup costs one hash, one displacement and one comparison, whatever the number of keys.

Shards and index are written under names that only the winning attempt of a task reports, so
a lost executor or a repeated task leaves nothing wrong behind.

Encoding runs the tokenizers library on the pieces that its own splitting rule cuts at single
spaces and line feeds, and remembers them: a space followed by a word starts a new piece in
any text. The new pieces of a few hundred texts go to the library in one call and are parted by
the ids that begin with a blank. Texts with other runs of white space, or with a special token,
go to the library whole. The remembered pieces are bounded and belong to the worker.

Cases: a null text is empty and has the end id only; repeated ids are separate keys
(id, occurrence), ordered by text; null ids come first; an empty table gives no shards and an
empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roomtide.llm.common import fast_list, mix, new_folder, open_folder, shared, worker_store

MAGIC = b"RTIDS\x01\x00\x00"
HEADER = "<8sII"  # magic, bytes per id, unused
HEADER_BYTES = struct.calcsize(HEADER)
CACHE_PIECES = 1_200_000
CHARACTERS_AT_ONCE = 4 << 20
LEARN_AT_ONCE = 4_096
SEGMENT_KEYS = 50_000
# ASCII marks; an apostrophe may belong to what follows.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# White space other than a space and a line feed, and the controls that libraries class differently.
OTHER_WHITE = re.compile("[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")


def single_spaced(text: str) -> bool:
    """Whether all white space of a text that is not empty is single spaces and line feeds between words."""
    if text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
        return False
    return OTHER_WHITE.search(text) is None


class Encoder:
    """Texts to ids, equal to encoding each whole text with the library.

    A piece is what stands between two blanks; the first of a line has its line feed before it. The
    pieces of many texts are numbered by Arrow, only the different ones are looked up or encoded, and
    the ids of all texts are gathered by number. The table has a young and an old half, so that
    frequent pieces outlive a full one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        size = self.library.get_vocab_size(True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.feed, self.blank = self.ids("\n"), self.ids(" ")
        lead = self.library.id_to_token(int(self.blank[0]))
        self.begins = np.array([(self.library.id_to_token(i) or "").startswith(lead) for i in range(size)])
        self.begins[self.feed[-1]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def encode(self, text: str) -> bytes:
        """The packed ids of one text."""
        return b"".join(self.encode_some([text]))

    def learn(self, pieces: list[str]) -> None:
        """Encode new pieces, thousands in one call: joined by blanks or line feeds, they are parted by the ids that begin one."""
        if len(self.young) + len(pieces) > CACHE_PIECES // 2:
            self.old, self.young = self.young, {}
        width = self.dtype.itemsize
        for low in range(0, len(pieces), LEARN_AT_ONCE):
            part = pieces[low : low + LEARN_AT_ONCE]
            # the blank before a line feed goes again
            joined = " ".join(part).replace(" \n", "\n")
            ids = self.ids(joined if joined[0] == "\n" else " " + joined)
            starts = np.flatnonzero(self.begins[ids])
            if len(starts) == len(part):
                raw, cuts = ids.tobytes(), (np.append(starts, len(ids)) * width).tolist()
                made = list(map(raw.__getitem__, map(slice, cuts[:-1], cuts[1:])))
            else:
                made = [self.ids(p if p[0] == "\n" else " " + p).tobytes() for p in part]
            self.young.update(zip(part, made))

    def known(self, pieces: list[str]) -> list[bytes]:
        made = list(map(self.young.get, pieces))
        missing = [i for i, m in enumerate(made) if m is None]
        for i in missing:
            made[i] = self.old.get(pieces[i])
            if made[i] is not None:
                self.young[pieces[i]] = made[i]
        missing = [i for i in missing if made[i] is None]
        if missing:
            self.learn([pieces[i] for i in missing])
            for i in missing:
                made[i] = self.young[pieces[i]]
        return made

    def table_of(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of different pieces in one array, with their starts and sizes.

        Marks after a letter or digit and before a blank are a piece of their own, so they are cut off and encoded apart.
        """
        stems = pc.utf8_rtrim(pieces, MARKS)
        length, whole = (pc.utf8_length(c).to_numpy(zero_copy_only=False) for c in (stems, pieces))
        marked = (length < whole) & pc.utf8_is_alnum(pc.utf8_slice_codeunits(stems, -1)).to_numpy(zero_copy_only=False)
        keys = pc.if_else(pa.array(marked), stems, pieces).dictionary_encode()
        made = self.known(fast_list(keys.dictionary))
        key = keys.indices.to_numpy(zero_copy_only=False)
        run = np.full(len(pieces), len(made))
        extra: dict[str, int] = {}
        for k in np.unique((whole - length)[marked]).tolist():
            at = np.flatnonzero(marked & (whole - length == k))
            tails = pc.utf8_slice_codeunits(pieces.take(pa.array(at)), -k).dictionary_encode()
            named = [extra.setdefault(t, len(made) + 1 + len(extra)) for t in tails.dictionary.to_pylist()]
            run[at] = np.array(named)[tails.indices.to_numpy(zero_copy_only=False)]
        if len(self.runs) > CACHE_PIECES // 10:
            self.runs.clear()
        for t in extra:
            if t not in self.runs:
                self.runs[t] = self.ids(t).tobytes()
        made = [*made, b"", *(self.runs[t] for t in extra)]
        sizes = np.fromiter(map(len, made), np.int64, len(made)) // self.dtype.itemsize
        starts = np.cumsum(sizes) - sizes
        both = np.stack((key, run), axis=1).ravel()
        table = gather(np.frombuffer(b"".join(made), self.dtype), starts[both], sizes[both])
        sizes = sizes[key] + sizes[run]
        return table, np.cumsum(sizes) - sizes, sizes

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        """The packed ids of the texts, in order."""
        low = 0
        while low < len(texts):
            high, size = low, 0
            while high < len(texts) and size < CHARACTERS_AT_ONCE:
                size += len(texts[high] or "") + 1
                high += 1
            yield from self.encode_some(texts[low:high])
            low = high

    def encode_some(self, texts: list[str | None]) -> Iterator[bytes]:
        plain = [bool(t) and single_spaced(t) and not any(mark in t for mark in self.special) for t in texts]
        spaced = pa.array(["\n" + t.replace("\n", " \n") for t, good in zip(texts, plain) if good], pa.large_string())
        split = pc.split_pattern(spaced, " ")
        numbered = split.flatten().dictionary_encode()
        table, starts, sizes = self.table_of(numbered.dictionary)
        number = numbered.indices.to_numpy(zero_copy_only=False)
        size = sizes[number]
        ends = np.cumsum(size)
        raw = gather(table, starts[number], size).tobytes()
        after = np.append(0, ends)[split.offsets.to_numpy()] * self.dtype.itemsize
        lead = len(self.feed) * self.dtype.itemsize  # the line feed before the first line
        cuts = zip(after[:-1].tolist(), after[1:].tolist())
        for text, good in zip(texts, plain):
            if good:
                start, end = next(cuts)
                yield raw[start + lead : end]
            else:
                yield self.ids(text).tobytes() if text else b""


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices of ``values`` one after the other."""
    ends = np.cumsum(sizes)
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


def encoder(path: str) -> Encoder:
    made = worker_store().__dict__.setdefault("encoders", {})
    if path not in made:
        made[path] = Encoder(path)
    return made[path]


def key_hash(doc_id: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    return mix(mix(doc_id.view(np.uint64)) + occurrence.astype(np.uint64))


def write_shards(df: DataFrame, tokenizer: str, end_id: int, folder: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Write the shards; a row per document: doc_id, occurrence, shard, offset (in ids) and n_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([end_id], encode.dtype).tobytes()
        width, offset, last, seen, sink = encode.dtype.itemsize, 0, None, 0, None
        name = f"{folder}/ids-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin"
        try:
            for batch in batches:
                rows = []
                for doc, packed in zip(batch.column(0).to_pylist(), encode.encode_all(batch.column(1).to_pylist())):
                    if sink is None:
                        files, path = open_folder(name)
                        files.create_dir(path.rpartition("/")[0], recursive=True)
                        sink = files.open_output_stream(path)
                        sink.write(struct.pack(HEADER, MAGIC, width, 0))
                        last = (doc,)
                    seen = seen + 1 if (doc,) == last and offset else 0
                    last = (doc,)
                    ids = packed + end
                    sink.write(ids)
                    rows.append((doc, seen, name, offset, len(ids) // width))
                    offset += len(ids) // width
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), SHARD_TYPES)], names=SHARD_NAMES)
        finally:
            if sink is not None:
                sink.close()

    dealt = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).repartitionByRange("doc_id")
    rows = dealt.sortWithinPartitions("doc_id", "text").mapInArrow(run, "doc_id bigint, occurrence bigint, shard string, offset bigint, n_tokens bigint")
    return shared(rows, "token-rows")


SHARD_NAMES = ["doc_id", "occurrence", "shard", "offset", "n_tokens"]
SHARD_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]


def perfect_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacements of the buckets, and the slot (0 to n - 1) of each of the distinct 64-bit keys."""
    n = len(keys)
    buckets = max(1, (n + 3) // 4)
    bucket = bucket_of(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    starts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    sizes = np.diff(starts)
    shift, slots, free = np.zeros(buckets, np.int64), np.zeros(n, np.int64), np.ones(n, bool)
    for b in np.argsort(-sizes, kind="stable"):
        size = sizes[b]
        if size == 0:
            break
        if size == 1:  # a key alone in its bucket takes a free slot directly
            alone = np.flatnonzero(sizes == 1)
            single = order[starts[alone]]
            slots[single] = np.flatnonzero(free)[: len(single)]
            shift[alone] = -1 - slots[single]
            break
        own = order[starts[b] : starts[b + 1]]
        base = 0
        while True:  # the first displacement that puts all keys of the bucket on free slots
            tries = np.arange(base, base + 64, dtype=np.int64)
            at = slot_of(keys[own][:, None], tries[None, :], n)
            ranked = np.sort(at, axis=0)
            good = free[at].all(axis=0) & (ranked[1:] != ranked[:-1]).all(axis=0)
            hit = np.flatnonzero(good)
            if len(hit):
                shift[b] = base + int(hit[0])
                slots[own] = at[:, hit[0]]
                free[at[:, hit[0]]] = False
                break
            base += len(tries)
    return shift, slots


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def slot_of(keys: np.ndarray, shift: np.ndarray, n: int) -> np.ndarray:
    hashed = (mix(keys + shift.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int64)
    return np.where(shift < 0, -1 - shift, hashed)


def fingerprint_of(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(33)).astype(np.int64)


INDEX = "segment bigint, n bigint, shift array<bigint>, finger array<bigint>, shard array<string>, offset array<bigint>, n_tokens array<bigint>"


def segment_count(rows: int) -> int:
    return max(1, -(-rows // SEGMENT_KEYS))


def build_index(rows: DataFrame, segments: int) -> DataFrame:
    """One row per segment: displacements, and by slot the fingerprint, shard, offset and length."""
    import pandas as pd

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        keys = part["key"].to_numpy(np.int64).view(np.uint64)
        shift, slots = perfect_hash(keys)
        place = np.argsort(slots)
        row = {"segment": key[0], "n": len(keys), "shift": shift, "finger": fingerprint_of(keys)[place]}
        return pd.DataFrame([row | {c: part[c].to_numpy()[place] for c in ("shard", "offset", "n_tokens")}])

    keyed = with_keys(rows, segments).select("segment", "key", "shard", "offset", "n_tokens")
    return shared(keyed.groupBy("segment").applyInPandas(build, INDEX), "token-index")


def with_keys(rows: DataFrame, segments: int) -> DataFrame:
    """``rows`` with the key of (doc_id, occurrence) and its segment, from doc_id and occurrence alone."""
    given = [f.name for f in rows.schema]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", key bigint, segment bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column(given.index("doc_id"))
            number = doc.fill_null(-1).to_numpy(zero_copy_only=False)
            # A null id is no number; its occurrences are counted apart.
            seen = batch.column(given.index("occurrence")).to_numpy(zero_copy_only=False) * 2 + doc.is_null().to_numpy(zero_copy_only=False)
            keys = key_hash(np.ascontiguousarray(number), seen)
            segment = (keys % np.uint64(segments)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys.view(np.int64)), pa.array(segment)], names=[*given, "key", "segment"])

    return rows.mapInArrow(run, schema)


def look_up(keys: DataFrame, index: DataFrame, segments: int) -> DataFrame:
    """``keys`` (doc_id, occurrence) with shard, offset and n_tokens; keys not in the index are left out."""
    import pandas as pd

    def find(_: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c: [] for c in ["doc_id", "absent", *SHARD_NAMES[1:]]})
        row = right.iloc[0]
        wanted = left["key"].to_numpy(np.int64).view(np.uint64)
        shift = np.asarray(row["shift"])
        slot = slot_of(wanted, shift[bucket_of(wanted, len(shift))], int(row["n"]))
        same = np.asarray(row["finger"])[slot] == fingerprint_of(wanted)
        found = left[["doc_id", "absent", "occurrence"]][same].copy()
        for c in ("shard", "offset", "n_tokens"):
            found[c] = np.asarray(row[c])[slot[same]]
        return found

    # pandas has no null integers, so a null id travels as a flag
    asked = with_keys(keys.select("doc_id", "occurrence"), segments)
    asked = asked.select("segment", "key", "occurrence", F.col("doc_id").isNull().alias("absent"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"))
    made = "doc_id bigint, absent boolean, occurrence bigint, shard string, offset bigint, n_tokens bigint"
    found = asked.groupBy("segment").cogroup(index.groupBy("segment")).applyInPandas(find, made)
    return found.select(F.when(~F.col("absent"), F.col("doc_id")).alias("doc_id"), *SHARD_NAMES[1:])


def read_documents(found: DataFrame) -> DataFrame:
    """The rows of ``found`` with ids_crc32, the checksum of their ids as 32-bit integers, read from the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = source = None
        for batch in batches:
            sums = []
            for shard, offset, n in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                if shard != name:
                    files, path = open_folder(shard)
                    name, source = shard, files.open_input_file(path)
                    magic, width, _ = struct.unpack(HEADER, source.read_at(HEADER_BYTES, 0))
                    if magic != MAGIC:
                        raise ValueError(f"{shard} is no token file")
                ids = np.frombuffer(source.read_at(n * width, HEADER_BYTES + offset * width), f"<u{width}")
                sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())], names=[*SHARD_NAMES, "ids_crc32"])

    dealt = found.select(*SHARD_NAMES).repartition("shard").sortWithinPartitions("shard", "offset")
    return dealt.mapInArrow(run, "doc_id bigint, occurrence bigint, shard string, offset bigint, n_tokens bigint, ids_crc32 bigint")


def shard_starts(rows: DataFrame) -> DataFrame:
    """shard and start: the ids of all shards before it, in ascending order of their documents; a row per shard."""
    sizes = rows.groupBy("shard").agg(F.min("doc_id").alias("low"), F.sum("n_tokens").alias("ids"))
    before = Window.orderBy(F.col("low").asc_nulls_first(), "shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))


def encode_and_read(
    spark: SparkSession, df: DataFrame, tokenizer: str, end_id: int, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every row, from the written files and through the index."""
    rows = write_shards(df, tokenizer, end_id, new_folder(spark, "token-shards"), text, doc_id)
    segments = segment_count(rows.count())
    index = build_index(rows, segments)
    found = read_documents(look_up(rows.select("doc_id", "occurrence"), index, segments))
    placed = found.join(shard_starts(rows), "shard")
    return placed.select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
