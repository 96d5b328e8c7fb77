"""Phrase collocation mining: exact counts of word n-grams, scored and the subsumed ones dropped.

Texts are cut into words by numpy and held in chunks as numbers of a chunk's own word list. The lists are counted and
joined with the frequent words, which gives every word of every chunk its id; rare words and ends of pieces
are 0. Two, three and four words are counted one after the other, each in counting quotient filters of a task, merged block by block.
An n-gram is only counted if its words are frequent and, by a bitmap of bounded size, its parts are: whoever has a rare
part is rare, so nothing is lost.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerwright.llm.common import batch_bytes
from layerwright.llm.counting_filter import Packing, counted, encode, merge
from layerwright.operators.joins import split_lookup
from layerwright.operators.keys import add_dense_id
from layerwright.session import stage, stage_counted

LONGEST = 4
MINIMUM = 30
TOP = 2000
SEPARATORS = ".,;:!?\n\x0b\x0c\r"
# Text of a chunk; a text of more is cut at ends of pieces, where no phrase passes.
CHUNK_BYTES = 4 << 20
# Distinct n-grams that a task holds before it adds them up, and entries a block has at most if none repeats.
HELD = 1 << 19
# Places of a chunk that are packed and counted at a time.
SLICE = 1 << 18
BLOCK_ENTRIES = 1 << 19
# The bitmap of frequent parts: so many bits an entry, up to 32 MB, beyond which it lets more n-grams pass and counts stay right.
BITS_AN_ENTRY = 12
MOST_BITS = 28
RANK_ROWS = 200_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in SEPARATORS]] = 2
_WORDS = [f"w{i + 1}" for i in range(LONGEST)]
_PART = _WORDS[: LONGEST - 1]


def _cut(text: np.ndarray) -> Iterator[np.ndarray]:
    """A text in pieces of about a chunk; only where pieces end."""
    while len(text) > CHUNK_BYTES:
        ends = np.flatnonzero(_KIND[text[:CHUNK_BYTES]] == 2)
        if not len(ends):
            ends = np.flatnonzero(_KIND[text[CHUNK_BYTES:]] == 2)[:1] + CHUNK_BYTES
        if not len(ends):
            break
        yield text[: ends[-1] + 1]
        text = text[ends[-1] + 1 :]
    yield text


def _chunk(langs: list[str], texts: list[np.ndarray]) -> pa.RecordBatch:
    """The words of some texts: a list of distinct (lang, word), their counts, and the texts as places in it, -1 between pieces."""
    names = sorted(set(langs))
    number = {name: i for i, name in enumerate(names)}
    stops = np.cumsum([len(t) + 1 for t in texts])
    data = np.full(int(stops[-1]), ord("\n"), np.uint8)
    for text, stop in zip(texts, stops):
        data[stop - 1 - len(text) : stop - 1] = text
    data = _LOWER[data]
    kind = _KIND[data]
    # A chunk is far below 2 GB, so 32 bits hold every place.
    inside = kind == 0
    starts = np.flatnonzero(inside & ~np.append(False, inside[:-1])).astype(np.int32)
    stops_of = np.flatnonzero(inside & ~np.append(inside[1:], False)).astype(np.int32)
    offsets = np.append(np.int32(0), np.cumsum(stops_of - starts + 1, dtype=np.int32))
    ends_before = np.cumsum(kind == 2, dtype=np.int32)[starts]
    del stops_of, kind
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    words = words.dictionary_encode()
    lang = np.array([number[name] for name in langs], np.int64)[np.searchsorted(stops, starts, side="right")]
    pairs = pa.array(words.indices.to_numpy() * np.int64(len(names)) + lang).dictionary_encode()
    codes = pairs.indices.to_numpy().astype("<i4")
    distinct = pairs.dictionary.to_numpy()
    out = np.full(len(codes) + int(np.count_nonzero(np.diff(ends_before))), -1, "<i4")
    out[np.arange(len(codes)) + np.append(0, np.cumsum(np.diff(ends_before) != 0))[: len(codes)]] = codes
    row = {
        "chunk": [uuid.uuid4().hex],
        "langs": [[names[i] for i in distinct % len(names)]],
        "words": [words.dictionary.take(pa.array(distinct // len(names))).cast(pa.string()).to_pylist()],
        "counts": [np.bincount(codes, minlength=len(distinct))],
        "codes": [out.tobytes()],
    }
    return pa.RecordBatch.from_pydict(row, schema=_CHUNK)


_CHUNK = pa.schema(
    [
        ("chunk", pa.string()),
        ("langs", pa.list_(pa.string())),
        ("words", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
        ("codes", pa.binary()),
    ]
)


def _tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    langs, texts, size = [], [], 0
    for batch in batches:
        body = batch.column("body").cast(pa.binary())
        for lang, text in zip(batch.column("lang").to_pylist(), body):
            for part in _cut(np.frombuffer(text.as_buffer(), np.uint8)):
                if not len(part):
                    continue
                langs.append(lang)
                texts.append(part)
                size += len(part)
                if size >= CHUNK_BYTES:
                    yield _chunk(langs, texts)
                    langs, texts, size = [], [], 0
    if texts:
        yield _chunk(langs, texts)


def _runs(ids: np.ndarray, words: int) -> list[np.ndarray]:
    return [ids[i : len(ids) - words + 1 + i] for i in range(words)]


def _slices(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The ids of chunks, cut so that every run of ``words`` ids lies in just one slice."""
    for data in column:
        ids = np.frombuffer(data.as_buffer(), "<u4")
        for start in range(0, len(ids) - words + 1, SLICE):
            yield ids[start : start + SLICE + words - 1]


def _probes(packing: Packing, left: np.ndarray, right: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places in a bitmap of 2^bits for a permuted n-gram."""
    mixed = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed >> np.uint64(64 - bits), (mixed * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - bits)


def _bitmap(frequent: DataFrame, rows: int, packing: Packing) -> np.ndarray:
    """A Bloom bitmap of the frequent n-grams: built in tasks, folded by Spark, at most 2^MOST_BITS bits in all."""
    bits = min(MOST_BITS, max(10, (rows * BITS_AN_ENTRY).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [batch.column(name).to_numpy() for name in _WORDS[: packing.words]]
            at = np.unique(np.concatenate(_probes(packing, *packing.permute(*packing.pack(ids)), bits)))
            cell = (at >> np.uint64(6)).astype(np.int64)
            first = np.flatnonzero(np.append(True, np.diff(cell) != 0)) if len(at) else []
            value = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else at
            yield pa.RecordBatch.from_pydict({"cell": cell[first], "bits": value.view(np.int64)})

    cells = frequent.mapInArrow(places, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy().view(np.uint64)
    return out


def _passes(bitmap: np.ndarray, packing: Packing, ids: np.ndarray) -> np.ndarray:
    bits = 6 + len(bitmap).bit_length() - 1
    keys = packing.permute(*packing.pack(_runs(ids, packing.words)))
    found = np.ones(len(keys[0]), bool)
    for at in _probes(packing, *keys, bits):
        found &= (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return found


def _count_ngrams(chunks: DataFrame, packing: Packing, tokens: int, minimum: int, parts: np.ndarray | None) -> tuple[DataFrame, int]:
    """The n-grams of ``packing.words`` words that occur ``minimum`` times: w1.., f. ``parts``: bitmap of the frequent ones a word shorter."""
    words = packing.words
    block_bits = min(packing.half, 24, (tokens // BLOCK_ENTRIES).bit_length())
    shorter = Packing(words - 1, packing.id_bits)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def added_up() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return counted(packing.half, *(np.concatenate(column) for column in zip(*held)))

        def rows(entries: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
            filters = encode(packing, block_bits, *entries)
            return pa.RecordBatch.from_pydict(
                {"block": pa.array([b for b, _ in filters], pa.int32()), "filter": pa.array([f for _, f in filters], pa.binary())}
            )

        for batch in batches:
            for ids in _slices(batch.column("ids"), words):
                run = _runs(ids, words)
                keep = np.logical_and.reduce([x != 0 for x in run])
                if parts is not None:
                    good = _passes(parts, shorter, ids)
                    keep &= good[:-1] & good[1:]
                at = np.flatnonzero(keep)
                entries = counted(packing.half, *packing.permute(*packing.pack([x[at] for x in run])))
                held.append(entries)
                size += len(entries[0])
                if size >= HELD:
                    entries = added_up()
                    held, size = [entries], len(entries[0])
                    if size > HELD // 2:
                        yield rows(entries)
                        held, size = [], 0
        if size:
            yield rows(added_up())

    def block(table: pa.Table) -> pa.Table:
        filters = list(zip(table.column("block").to_pylist(), table.column("filter").to_pylist()))
        left, right, counts = merge(packing, filters)
        often = counts >= minimum
        ids = packing.unpack(*packing.restore(left[often], right[often]))
        return pa.table({**{w: x.astype(np.int64) for w, x in zip(_WORDS, ids)}, "f": counts[often]})

    schema = ", ".join(f"{w} long" for w in _WORDS[:words])
    filters = chunks.mapInArrow(shard, "block int, filter binary")
    return stage_counted(filters.groupBy("block").applyInArrow(block, f"{schema}, f long"), f"phrases-{words}")


def _padded(counts: DataFrame, words: int, width: int) -> DataFrame:
    names = _WORDS[:width]
    return counts.select(*[(F.col(w) if i < words else F.lit(0).cast("long")).alias(w) for i, w in enumerate(names)], "f")


def _part(words: list[str]) -> Column:
    return F.struct(*[(F.col(words[i]) if i < len(words) else F.lit(0).cast("long")).alias(w) for i, w in enumerate(_PART)])


def _scored(candidates: DataFrame, parts: DataFrame) -> DataFrame:
    """Candidates with l, r and score of their lowest-scoring cut."""
    per_size = F.lit(None)
    for size in range(2, LONGEST + 1):
        cuts = [
            F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), _part(part).alias("part"))
            for k in range(1, size)
            for side, part in (("l", _WORDS[:k]), ("r", _WORDS[k:size]))
        ]
        per_size = F.when(F.col("size") == size, F.array(*cuts)).otherwise(per_size)
    cut = candidates.select(*_WORDS, "size", "a", F.explode(per_size).alias("cut")).select(
        *_WORDS, "size", "a", "cut.k", "cut.side", *[F.col(f"cut.part.{w}").alias(f"part_{w}") for w in _PART]
    )
    keys = [f"part_{w}" for w in _PART]
    found = split_lookup(cut, parts.withColumnsRenamed(dict(zip(_PART, keys))), keys)
    sides = found.groupBy(*_WORDS, "size", "a", "k").agg(
        F.max(F.when(F.col("side") == "l", F.col("f"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("f"))).alias("r")
    )
    score = F.expr("(CAST(2000000 AS DECIMAL(19, 0)) * CAST(a AS DECIMAL(19, 0))) DIV (CAST(l AS DECIMAL(19, 0)) + CAST(r AS DECIMAL(19, 0)))")
    lowest = F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("lowest")
    return sides.groupBy(*_WORDS, "size", "a").agg(lowest).select(*_WORDS, "size", "a", "lowest.l", "lowest.r", "lowest.score")


def _subsuming(candidates: DataFrame) -> DataFrame:
    """For phrases inside longer candidates the largest count of such a one: w1.., longest_f."""
    per_size = F.lit(None)
    for size in range(3, LONGEST + 1):
        inner = [_part(_WORDS[i : i + n]) for n in range(2, size) for i in range(size - n + 1)]
        per_size = F.when(F.col("size") == size, F.array(*inner)).otherwise(per_size)
    inside = candidates.filter("size > 2").select("a", F.explode(per_size).alias("part"))
    return inside.select("a", "part.*").groupBy(*_PART).agg(F.max("a").alias("longest_f"))


def mine_phrases(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", minimum: int = MINIMUM, top: int = TOP
) -> DataFrame:
    """The ``top`` phrases of two to four words of each language: lang, rank, phrase, a, l, r, n, score.

    Words are lower-cased (A-Z), divided by blanks and tabs, within pieces divided by ``SEPARATORS``. A null text is
    empty, a null language ``und``; texts without words, empty tables and languages without a phrase of ``minimum``
    occurrences give no row. Every row counts, repeated ones too. Ties go by count, then phrase in byte order; further columns are not read.
    """
    spark = docs.sparkSession
    given = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("body"),
    )
    schema = "chunk string, langs array<string>, words array<string>, counts array<long>, codes binary"
    with batch_bytes(spark, "2m"):
        chunks = stage(given.mapInArrow(_tokenise, schema), "phrase-chunks")
    listed = chunks.select("chunk", F.posexplode(F.arrays_zip("langs", "words", "counts")).alias("place", "w")).select(
        "chunk", "place", F.col("w.langs").alias("lang"), F.col("w.words").alias("word"), F.col("w.counts").alias("f")
    )
    totals = stage(listed.groupBy("lang", "word").agg(F.sum("f").alias("f")), "phrase-words")
    per_lang = totals.groupBy("lang").agg(F.sum("f").alias("n"))
    words, vocabulary = stage_counted(add_dense_id(totals.filter(F.col("f") >= minimum), ["lang", "word"], "id"), "phrase-vocabulary")
    if vocabulary >= 1 << 32:
        raise ValueError(f"{vocabulary} frequent words: their ids take more than 32 bits")
    tokens = words.agg(F.coalesce(F.sum("f"), F.lit(0)).alias("t")).first().t
    id_bits = max(1, vocabulary.bit_length())

    ids = split_lookup(listed.drop("f"), words.select("lang", "word", "id"), ["lang", "word"])
    per_chunk = ids.groupBy("chunk").agg(F.collect_list(F.struct("place", "id")).alias("ids"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, listed in zip(batch.column("codes"), batch.column("ids")):
                places = np.frombuffer(codes.as_buffer(), "<i4")
                entries = listed.values
                # The last place is that of -1, the end of a piece.
                table = np.zeros(int(places.max()) + 2, "<u4")
                table[entries.field("place").to_numpy()] = entries.field("id").to_numpy()
                yield pa.RecordBatch.from_pydict({"ids": pa.array([table[places].tobytes()], pa.binary())})

    with batch_bytes(spark, "2m"):
        numbered = stage(chunks.select("chunk", "codes").join(per_chunk, "chunk").mapInArrow(number, "ids binary"), "phrase-ids")
        counts, parts = {1: words.select(F.col("id").alias("w1"), "f")}, None
        for size in range(2, LONGEST + 1):
            packing = Packing(size, id_bits)
            counts[size], rows = _count_ngrams(numbered, packing, tokens, minimum, parts)
            if size < LONGEST:
                parts = _bitmap(counts[size], rows, packing)

    candidates = None
    for size in range(2, LONGEST + 1):
        some = _padded(counts[size], size, LONGEST).select(*_WORDS, F.lit(size).alias("size"), F.col("f").alias("a"))
        candidates = some if candidates is None else candidates.unionByName(some)
    parts_table = None
    for size in range(1, LONGEST):
        some = _padded(counts[size], size, LONGEST - 1)
        parts_table = some if parts_table is None else parts_table.unionByName(some)
    inside = _subsuming(candidates).withColumn("w4", F.lit(0).cast("long"))
    kept = candidates.join(inside, _WORDS, "left").filter(
        F.col("longest_f").isNull()
        | (F.lit(100).cast("decimal(19,0)") * F.col("longest_f") < F.lit(80).cast("decimal(19,0)") * F.col("a"))
    )
    scored = _scored(kept.drop("longest_f"), parts_table)
    named = split_lookup(scored, words.select(F.col("id").alias("w1"), "lang"), ["w1"])
    named, rows = stage_counted(named, "phrase-scores")

    # Ranked in parts first, so that no task sees all phrases of a language; equals stay until their words are there.
    best = [F.desc("score"), F.desc("a")]
    salted = named.withColumn("part", F.pmod(F.xxhash64(*_WORDS), F.lit(1 + rows // RANK_ROWS)))
    first = salted.withColumn("rank", F.rank().over(Window.partitionBy("lang", "part").orderBy(*best))).filter(F.col("rank") <= top)
    near = first.withColumn("rank", F.rank().over(Window.partitionBy("lang").orderBy(*best))).filter(F.col("rank") <= top).drop("rank", "part")
    spelt = near.select("*", F.posexplode(F.array(*_WORDS)).alias("place", "id")).filter("id > 0")
    spelt = split_lookup(spelt, words.select("id", "word"), ["id"])
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"])
    phrases = spelt.groupBy(*near.columns).agg(F.array_join(in_order, " ").alias("phrase"))
    ranked = phrases.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best, "phrase"))).filter(F.col("rank") <= top)
    return ranked.join(per_lang, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
