"""MinHash near-dedup with tensored banding.

A pair is found when it meets in one of ``left * right`` hash tables. The keys of those tables are not computed
one by one: two small collections of band hashes are made, ``left`` of two minhashes and ``right`` of three, and
every table key combines one of each. So 9 + 13 bands (57 minhashes) serve 117 tables of five minhashes each;
a lower similarity than 0.8 gets other numbers by the same rule (``bands_for``).
At a similarity of 0.8 a pair stays unseen with probability 0.36^9 + 0.49^13, about 2 in 10,000, and such a pair
still lands in one group when any third text links both.

What happens to the rows:

1. Texts with the same set of shingles form a class, told apart by 127 bits of a digest; only classes go on.
2. In each bucket the smallest class is the leader and every member is compared with it: links per bucket grow
   with its size, not with the square. Compared means: minhash agreement and parities first, then the full sets.
   The parities bound from below what two sets do not share, so they turn away no similar pair, and of large groups
   of texts that are alike but not similar enough few pairs are left.
3. Connected components. Buckets of more than two whose members are now in different components are looked at
   once more, so members that missed the leader find each other: pairs across components that share one of their
   rarest shingles, which similar sets must.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.llm.common import free_name, row_key, small_batches
from layerwright.operators.joins import split_lookup
from layerwright.session import stage

# Of a thousand pairs at the asked similarity fewer than so many share no table.
MISSED_PER_THOUSAND = 1
MOST_TABLES = 128
MEMBERS_PER_TASK_GROUP = 256
MAP_BITS = 1 << 23
SHINGLES_AT_ONCE = 1024
# Places that shingles are dealt to for the parities of a set, 128 bytes a set.
PARITIES = 1024

_WORDS_KEPT = 400_000
_word_hashes: dict[bytes, int] = {}


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; with fewer words the whole sequence is one."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(_word_hashes) > _WORDS_KEPT:
        _word_hashes.clear()
    known = _word_hashes
    for word in set(words):
        if word not in known:
            known[word] = xxhash.xxh3_64_intdigest(word)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    span = min(width, len(words))
    mixed = np.full(len(words) - span + 1, span, np.uint64)
    for k in range(span):
        mixed = (mixed ^ hashes[k : k + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


@dataclass(frozen=True)
class Bands:
    """The two collections of bands: how many, and of how many minhashes each."""

    left: int
    left_rows: int
    right: int
    right_rows: int

    @property
    def hashes(self) -> int:
        return self.left * self.left_rows + self.right * self.right_rows

    def missed(self, percent: int) -> float:
        """The chance that a pair of that similarity shares no table: all bands of a collection differ."""
        s = percent / 100
        left, right = (1 - s**self.left_rows) ** self.left, (1 - s**self.right_rows) ** self.right
        return left + right - left * right


def bands_for(percent: int) -> Bands:
    """The bands for a similarity: 9 of 2 and 13 of 3 down to 0.8, below as many minhashes a table as few enough tables allow."""
    usual = Bands(9, 2, 13, 3)
    if 1000 * usual.missed(percent) < MISSED_PER_THOUSAND:
        return usual
    found = [
        Bands(left, left_rows, right, right_rows)
        for left_rows, right_rows in ((2, 2), (1, 2), (1, 1))
        for left in range(1, MOST_TABLES + 1)
        for right in range(1, MOST_TABLES // left + 1)
        if 1000 * Bands(left, left_rows, right, right_rows).missed(percent) < MISSED_PER_THOUSAND
    ]
    if not found:
        raise ValueError(f"a similarity of {percent} % is too low for hash tables; 50 is the least that can be asked for")
    return min(found, key=lambda b: (-b.left_rows - b.right_rows, b.left * b.right, b.hashes))


@cache
def _multipliers(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(20240229).integers(1, 2**63, size=(2, hashes), dtype=np.uint64)
    return drawn[0] * np.uint64(2) + np.uint64(1), drawn[1]


def minhashes(shingles: np.ndarray, hashes: int) -> np.ndarray:
    """The signature: for each hash function the upper half of the smallest value, as int32."""
    factors, shifts = _multipliers(hashes)
    if len(shingles) <= SHINGLES_AT_ONCE:
        # All functions at once, as long as their values stay in a core's cache.
        values = shingles * factors[:, None]
        values += shifts[:, None]
        out = values.min(axis=1)
    else:
        out = np.array([(shingles * factor + shift).min() for factor, shift in zip(factors, shifts)])
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def parities(shingles: np.ndarray) -> np.ndarray:
    """For each of ``PARITIES`` places whether an odd number of the shingles falls on it, packed into longs.

    Shared shingles cancel out, so two sets differ in at least as many shingles as their parities differ in places.
    """
    places = (shingles & np.uint64(PARITIES - 1)).astype(np.int64)
    odd = (np.bincount(places, minlength=PARITIES) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _signed(batches: Iterator[pd.DataFrame], width: int, scheme: Bands) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts, classes, checks, signatures, odds = [], [], [], [], []
        for text in batch.body:
            shingles = shingle_set(text, width)
            counts.append(len(shingles))
            if len(shingles):
                digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
                classes.append(int.from_bytes(digest[:8], "little") >> 1)
                checks.append(int.from_bytes(digest[8:], "little", signed=True))
                signatures.append(minhashes(shingles, scheme.hashes))
                odds.append(parities(shingles))
            else:
                classes.append(None)
                checks.append(None)
                signatures.append(None)
                odds.append(None)
        yield pd.DataFrame(
            {
                "row_key": batch.row_key,
                "doc_id": batch.doc_id,
                "n_shingles": counts,
                "class": pd.array(classes, "Int64"),
                "check": pd.array(checks, "Int64"),
                "signature": signatures,
                "parities": odds,
            }
        )


def sign(
    docs: DataFrame, width: int, scheme: Bands, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: row_key, doc_id, n_shingles, class and check (63 and 64 bits of a digest of the shingle set), signature, parities."""
    small_batches(docs.sparkSession)
    body = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("body")).select(
        row_key(F.col("doc_id"), F.col("body")).alias("row_key"), F.col("doc_id").cast("string").alias("doc_id"), "body"
    )
    # Ids go as text: beside a null pandas would make them floats, which hold 53 bits.
    signed = body.mapInPandas(
        lambda batches: _signed(batches, width, scheme),
        "row_key string, doc_id string, n_shingles long, class long, check long, signature array<int>, parities array<long>",
    )
    return signed.withColumn("doc_id", F.col("doc_id").cast("long"))


def classes_of(signed: DataFrame) -> DataFrame:
    """One row per class: its smallest row_key, set size, signature and parities, and the least and greatest check of its rows."""
    return (
        signed.filter("n_shingles > 0")
        .groupBy("class")
        .agg(
            F.min("row_key").alias("row_key"),
            F.first("n_shingles").alias("n"),
            F.first("signature").alias("signature"),
            F.first("parities").alias("parities"),
            F.min("check").alias("low"),
            F.max("check").alias("high"),
        )
    )


def tell_apart(signed: DataFrame, clashes: DataFrame) -> DataFrame:
    """``signed`` with a class of its own for each set that shares a class with another.

    ``clashes`` (class, low) names the classes whose rows differ in their check. Rows with the least check stay,
    the others get a class made of class and check.
    """
    other = F.shiftrightunsigned(F.xxhash64("class", "check"), 1)
    found = split_lookup(signed, clashes.select("class", "low"), ["class"], "left")
    return found.withColumn("class", F.when(F.col("check") > F.col("low"), other).otherwise(F.col("class"))).drop("low")


def _bands(signature: Column, scheme: Bands) -> tuple[Column, Column]:
    def cut(offset: int, count: int, rows: int, salt: int) -> Column:
        return F.array(
            *[
                F.xxhash64(F.lit(salt), *[F.get(signature, F.lit(offset + b * rows + r)) for r in range(rows)])
                for b in range(count)
            ]
        )

    offset = scheme.left * scheme.left_rows
    return cut(0, scheme.left, scheme.left_rows, 1), cut(offset, scheme.right, scheme.right_rows, 2)


def table_keys(classes: DataFrame, scheme: Bands) -> DataFrame:
    """class, key: one row for each hash table; the key names the table and both bands."""
    left, right = _bands(F.col("signature"), scheme)
    return (
        classes.select("class", left.alias("left"), right.alias("right"))
        .select("class", "right", F.posexplode("left").alias("i", "a"))
        .select("class", "i", "a", F.posexplode("right").alias("j", "b"))
        .select("class", F.xxhash64("i", "a", "j", "b").alias("key"))
    )


def _agree(a: Column, b: Column, percent: int, hashes: int) -> Column:
    """Minhashes agree often enough for a pair of that similarity: 6 standard deviations below the expectation, a chance of 1 in a billion."""
    p = percent / 100
    least = max(1, int(hashes * p - 6.2 * (hashes * p * (1 - p)) ** 0.5))
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same >= least


def _differ_little(a: Column, b: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    """Whether the parities let the sets be similar: those differ in at most (1 - p) / (1 + p) of both sizes. Exact, drops no similar pair."""
    apart = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return apart * (100 + percent) <= (n_a + n_b) * (100 - percent)


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _fetch_sets(docs: DataFrame, wanted: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """class, shingles for the rows that ``wanted`` (class, row_key) names.

    Texts are not shuffled for it: a bitmap of fixed size (``MAP_BITS``, one megabyte) tells each task which rows
    may be wanted, and the join afterwards drops those it let through in vain.
    """
    place = F.pmod(F.xxhash64("row_key"), F.lit(MAP_BITS))
    words = (
        wanted.select((place / 64).cast("long").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int")).alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toPandas()
    )
    bitmap = np.zeros(MAP_BITS // 64, np.int64)
    bitmap[words.word.to_numpy(np.int64)] = words.bits.to_numpy(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(np.unpackbits(bitmap.view(np.uint8), bitorder="little").tobytes())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        maybe = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            picked = batch[maybe[batch.place.to_numpy()] == 1]
            if len(picked):
                sets = [shingle_set(t, width).view(np.int64) for t in picked.body]
                yield pd.DataFrame({"row_key": picked.row_key, "shingles": sets})

    small_batches(docs.sparkSession)
    bodies = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("body")).select(
        row_key(F.col("doc_id"), F.col("body")).alias("row_key"), "body"
    )
    found = bodies.withColumn("place", place).select("row_key", "place", "body").mapInPandas(
        run, "row_key string, shingles array<long>"
    )
    # A class names one row; a row that is there more than once has the same set each time.
    return found.join(wanted, "row_key").select("class", "shingles").dropDuplicates(["class"])


def _compare(batches: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    """Rows come sorted by (leader, salt), the leader's own set first; one set is held at a time."""
    held, held_set = None, None
    for batch in batches:
        a, b = [], []
        for leader, salt, member, own in zip(batch.leader, batch.salt, batch["class"], batch.shingles):
            if (leader, salt) != held:
                held = (leader, salt)
            if member == leader:
                held_set = own
                continue
            both = len(np.intersect1d(held_set, own, assume_unique=True))
            if 100 * both >= percent * (len(held_set) + len(own) - both):
                a.append(leader)
                b.append(member)
        yield pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar. The set of ``a`` is sent once for some hundred partners."""
    fans = stage(
        pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(MEMBERS_PER_TASK_GROUP)).alias("salts")), "near-fans"
    )
    members = split_lookup(pairs, fans, ["a"]).select(
        F.col("a").alias("leader"), F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt"), F.col("b").alias("class")
    )
    leaders = fans.select(
        F.col("a").alias("leader"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt")
    ).withColumn("class", F.col("leader"))
    fetched = members.unionByName(leaders).join(sets, "class").withColumn("later", F.col("class") != F.col("leader"))
    small_batches(pairs.sparkSession)
    grouped = fetched.repartition("leader", "salt").sortWithinPartitions("leader", "salt", "later", "class")
    compared = grouped.select("leader", "salt", "class", "shingles").mapInPandas(
        lambda batches: _compare(batches, percent), "a long, b long"
    )
    return compared.distinct()


def _share_rare(classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """class, place, token, earlier: the rarest shingles of each set, as many as a similar set cannot all miss.

    With all shingles in one order, rarest first, two sets of similarity p share one of the first
    n - ceil(p * n) + 1 of each. Frequent shingles come last, so texts that share a passage only do not meet.
    """
    tokens = classes.select("class").join(sets, "class").select("class", F.explode("shingles").alias("token"))
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("often"))
    ranked = split_lookup(tokens, often, ["token"])
    ordered = ranked.groupBy("class").agg(F.array_sort(F.collect_list(F.struct("often", "token"))).alias("tokens"))
    size = F.size("tokens")
    least = F.ceil(size * F.lit(percent) / F.lit(100) - F.lit(1e-9))
    first = F.slice("tokens", F.lit(1), (size - least + 1).cast("int"))
    # A shingle of one set only meets nothing.
    placed = ordered.select("class", first.alias("firsts"), F.posexplode(first).alias("place", "t"))
    earlier = F.filter(F.slice("firsts", F.lit(1), F.col("place")), lambda t: t["often"] > 1)["token"]
    return placed.filter("t.often > 1").select("class", "place", "t.token", earlier.alias("earlier"))


def _can_reach(a: Column, b: Column, percent: int) -> Column:
    """Whether the rest of both sets from a shared shingle on can hold enough; true where it is the first shared one."""
    rest = F.least(a["n"] - a["place"], b["n"] - b["place"])
    return rest * (100 + percent) >= (a["n"] + b["n"]) * percent


def connected_components(links: DataFrame) -> DataFrame:
    """node, label (the smallest node it can reach) for every node of ``links`` (a, b), longs.

    Large-star and small-star steps in turn: every node hands its neighbours to the smallest one it sees. Each
    step is two joins on small rows, hot nodes are split, and the number of steps grows with the logarithm.
    """
    edges = stage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "cc"
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = split_lookup(both, least, ["u"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.filter("u != v").distinct(), "cc-large")
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = split_lookup(large, down, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(down.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        edges = stage(small, "cc-small")
        seen = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64("u", "v")).alias("x"),
            F.count_distinct("u").alias("nodes"),
        ).first()
        if seen == state and seen.n == seen.nodes:
            break
        state = seen
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def near_dedup(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: row_key, doc_id, n_shingles, component_id, kept.

    Words are runs of non-blank characters, lower-cased A-Z; a document's set are its distinct shingles of
    ``width`` words, with fewer words the whole sequence. Documents are linked when
    100 * intersection >= ``percent`` * union. component_id is the smallest doc_id that links can reach; the rows
    with that doc_id are kept. Null texts and texts without words have an empty set and are linked with nothing.
    Null identifiers lose against all others; a component of null identifiers only has a null component_id, and
    all its rows are kept. Other columns are not read; an empty table gives an empty result.
    """
    scheme = bands_for(percent)
    signed = stage(sign(docs, width, scheme, id_col, text_col), "near-signed")
    classes = stage(classes_of(signed), "near-classes")
    clashes = classes.filter("low < high")
    if not clashes.isEmpty():
        signed = stage(tell_apart(signed, clashes), "near-signed")
        classes = stage(classes_of(signed), "near-classes")
    keyed = table_keys(classes, scheme)
    shared = keyed.groupBy("key").agg(F.min("class").alias("leader"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    members = stage(split_lookup(keyed, shared, ["key"]).select("key", "leader", "m", "class"), "near-members")
    marks = classes.select("class", "n", "signature", "parities")

    def likely(pairs: DataFrame) -> DataFrame:
        left, right = (
            marks.select(*[F.col(c).alias(to) for c, to in (("class", side), ("n", f"n_{side}"), ("signature", f"sig_{side}"), ("parities", f"odd_{side}"))])
            for side in ("a", "b")
        )
        close = (
            _sizes_fit(F.col("n_a"), F.col("n_b"), percent)
            & _differ_little(F.col("odd_a"), F.col("odd_b"), F.col("n_a"), F.col("n_b"), percent)
            & _agree(F.col("sig_a"), F.col("sig_b"), percent, scheme.hashes)
        )
        return pairs.join(left, "a").join(right, "b").filter(close).select("a", "b")

    with_leader = members.filter("leader != class").select(F.col("leader").alias("a"), F.col("class").alias("b"))
    first = stage(likely(with_leader.distinct()), "near-pairs")
    # Only sets of classes in likely pairs, or in buckets where more than the leader could be similar, are needed.
    crowded = members.filter("m > 2")
    involved = first.select(F.col("a").alias("class")).union(first.select("b")).union(crowded.select("class")).distinct()
    wanted = stage(classes.join(involved, "class").select("class", "row_key"), "near-wanted")
    sets = stage(_fetch_sets(docs, wanted, width, id_col, text_col), "near-sets")
    links = stage(_confirmed(first, sets, percent), "near-links")
    labels = stage(connected_components(links), "near-labels")

    # Buckets of more than two that hold several components: pairs across components that share a rare shingle.
    placed = crowded.join(labels, crowded["class"] == labels["node"], "left").select(
        "key", "class", F.coalesce("label", "class").alias("label")
    )
    mixed = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    open_classes = stage(split_lookup(placed, mixed.select("key"), ["key"]).select("class").distinct(), "near-open")
    rare = stage(_share_rare(open_classes, sets, percent).join(marks, "class"), "near-rare")

    def labelled() -> DataFrame:
        return rare.join(labels, rare["class"] == labels["node"], "left").select(
            "token", "earlier", "class", "signature", "parities", F.struct("n", "place").alias("at"), F.coalesce("label", "class").alias("label")
        )

    x, y = labelled().alias("x"), labelled().alias("y")
    across = x.join(
        y,
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.label") != F.col("y.label"))
        & (F.col("x.class") < F.col("y.class"))
        & _sizes_fit(F.col("x.at.n"), F.col("y.at.n"), percent)
        & _can_reach(F.col("x.at"), F.col("y.at"), percent)
        & _differ_little(F.col("x.parities"), F.col("y.parities"), F.col("x.at.n"), F.col("y.at.n"), percent)
        & _agree(F.col("x.signature"), F.col("y.signature"), percent, scheme.hashes)
        # A pair comes once, at the first shingle it shares.
        & ~F.arrays_overlap("x.earlier", "y.earlier"),
    ).select(F.col("x.class").alias("a"), F.col("y.class").alias("b"))
    second = stage(across.distinct().join(first, ["a", "b"], "left_anti"), "near-across")
    if not second.isEmpty():
        links = stage(links.unionByName(_confirmed(second, sets, percent)), "near-links")
        labels = stage(connected_components(links), "near-labels")

    grouped = signed.select("row_key", "doc_id", "n_shingles", "class").join(
        labels, F.col("class") == F.col("node"), "left"
    )
    grouped = grouped.withColumn("label", F.coalesce("label", "class")).select(
        "row_key", "doc_id", "n_shingles", "label"
    )
    smallest = grouped.filter(F.col("label").isNotNull()).groupBy("label").agg(
        F.min("doc_id").alias("smallest"), F.count(F.lit(1)).alias("rows")
    )
    named = split_lookup(grouped, smallest.filter("rows > 1").drop("rows"), ["label"], "left")
    component = F.coalesce(F.col("smallest"), F.col("doc_id"))
    return named.select(
        "row_key",
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of every component, with all its columns; rows that repeat id and text stay once."""
    judged = near_dedup(docs, width, percent)
    key = free_name(docs.columns, "__row_key")
    kept = stage(judged.filter("kept").select(F.col("row_key").alias(key)).distinct(), "near-kept")
    marked = docs.withColumn(key, row_key(F.col("doc_id").cast("long"), F.col("text")))
    return marked.join(kept, key).dropDuplicates([key]).select(*[F.col(f"`{c}`") for c in docs.columns])
