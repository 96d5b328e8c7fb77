"""The operators of the llm folder on small tables: brute-force versions, round trips and odd rows."""

import gzip
import hashlib
import io
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from layerwright.llm import byte_pairs, chat, common, mixing, near_dedup, quality, sharding, token_counts, toxicity, warc
from layerwright.llm.decontaminate import contaminated_pairs, decontaminate
from layerwright.llm.exact_dedup import exact_dedup
from layerwright.llm.queries import registry
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_key string, size int, label int"
LONG = "word " * 30000
ODD = [
    (1, "Same text here now ok", "en", "a", 1, "x", 1, 1),
    (2, "same TEXT here now ok", "en", "a", 1, "x", 1, 1),
    (2, "same TEXT here now ok", "en", "a", 1, "x", 1, 1),
    (3, None, None, None, None, None, None, None),
    (4, "", "en", "b", 0, "", 0, 0),
    (None, "Same text here now ok", "en", None, 1, "x", 1, 1),
    (5, LONG, "en", "b", 1, "x", 1, 1),
    (6, "É é", "fr", "b", 1, "x", 1, 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.mark.parametrize("name", sorted(registry.sql.keys() - {"pipeline"}))
def test_query_agrees_with_sql(spark, name):
    rows, problems = compare(contract.queries()[name](spark, SF_DIR), connect(SF_DIR), contract.oracle_sql()[name])
    assert not problems
    assert rows > 0


def test_exact_dedup(odd, empty):
    rows = exact_dedup(odd, keep="largest").collect()
    assert len(rows) == len(ODD)
    same = [r for r in rows if r.text_sha256 == hashlib.sha256(b"same text here now ok").hexdigest()]
    assert {(r.keep_id, r.group_size) for r in same} == {(2, 4)} and sum(r.kept for r in same) == 1
    blank = [r for r in rows if r.text_sha256 == hashlib.sha256(b"").hexdigest()]
    assert {(r.doc_id, r.keep_id, r.kept) for r in blank} == {(3, 4, False), (4, 4, True)}
    assert {r.keep_id for r in exact_dedup(odd).collect() if r.doc_id in (1, 2, None)} == {1}
    assert exact_dedup(empty).count() == 0


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("run_rows", [1, 7, 20_000])
def test_exact_dedup_of_heavy_texts(spark, keep, run_rows):
    """Runs of any length give what a plain grouping does, with ids that repeat, null ids and texts without any id."""
    hot = [(i % 90, "Hot") for i in range(300)] + [(None, "hOT")] * 100 + [(None, "none")] * 60 + [(9, "nine")] * 40
    rows = hot + [(1000 + i, f"t{i % 30}") for i in range(90)] + [(5000, None), (5001, "")]
    given = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = exact_dedup(given, keep=keep, run_rows=run_rows).collect()
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(hashlib.sha256((text or "").lower().encode()).hexdigest(), []).append(doc_id)
    assert sorted((r.doc_id or -1, r.text_sha256) for r in found) == sorted((i or -1, h) for h, ids in groups.items() for i in ids)
    for digest, ids in groups.items():
        same, known = [r for r in found if r.text_sha256 == digest], [i for i in ids if i is not None]
        best = (min if keep == "smallest" else max)(known) if known else None
        assert {(r.keep_id, r.group_size) for r in same} == {(best, len(ids))}
        assert [r.doc_id for r in same if r.kept] == [best]


def test_decontamination(spark, odd, empty):
    items = spark.createDataFrame(
        [(1, "text here"), (2, "a b c d e f g h i j"), (3, None), (4, " "), (None, "É é")], "item_id long, text string"
    )
    found = {(r.doc_id, r.item_id, r.containment) for r in contaminated_pairs(odd, items).collect()}
    assert found == {(1, 1, 1.0), (2, 1, 1.0), (None, 1, 1.0), (6, None, 1.0)}
    assert {r.doc_id for r in decontaminate(odd, items).collect()} == {3, 4, 5}
    assert contaminated_pairs(empty, items).count() == 0
    assert decontaminate(odd, items.limit(0)).count() == len(ODD)


def _brute_components(rows, width):
    sets = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        span = min(width, len(words))
        sets[doc_id] = {tuple(words[i : i + span]) for i in range(len(words) - span + 1)} if words else set()
    label = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {d: (len(sets[d]), label[d]) for d in sets}


def test_near_dedup_against_all_pairs(docs):
    expected = _brute_components([(r.doc_id, r.text) for r in docs.collect()], 2)
    found = near_dedup.near_dedup(docs, width=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected


def test_near_dedup_tells_sets_with_one_class_apart(docs, monkeypatch):
    sign = near_dedup.sign
    monkeypatch.setattr(near_dedup, "sign", lambda *a: sign(*a).withColumn("class", F.col("class") % 5))
    expected = _brute_components([(r.doc_id, r.text) for r in docs.collect()], 2)
    found = near_dedup.near_dedup(docs, width=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected


def test_near_dedup_odd_rows(odd, empty):
    found = {(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_dedup(odd, 2).collect()}
    assert found == {(1, 1, True), (2, 1, False), (None, 1, False), (3, 3, True), (4, 4, True), (5, 5, True), (6, 6, True)}
    assert near_dedup.near_dedup(empty, 2).count() == 0
    assert sorted(r.doc_id for r in near_dedup.drop_near_copies(odd).collect()) == [1, 3, 4, 5, 6]


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    found = {r.node: r.label for r in near_dedup.connected_components(links).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_mixing(docs, odd, empty):
    rows = mixing.mix_sources(docs).collect()
    again = mixing.mix_sources(docs.repartition(5)).collect()
    assert {r.row_key: (r.copies, r.more) for r in rows} == {r.row_key: (r.copies, r.more) for r in again}
    by_source = {}
    for r in rows:
        assert 0 <= r.copies <= 3 and 0 <= r.more <= r.repeats and (r.copies < 3 or not r.more)
        entry = by_source.setdefault(r.source, [r.target, 0, 0, r.source_size])
        entry[1] += (r.copies * r.repeats + r.more) * r.size
        entry[2] = max(entry[2], r.size)
    for target, taken, largest, size in by_source.values():
        assert abs(target - taken) <= largest / 2 + 1e-6 and target <= 3 * size + 1e-6
    assert sum(e[0] for e in by_source.values()) == pytest.approx(sum(e[3] for e in by_source.values()))
    assert sum(r.repeats for r in mixing.mix_sources(odd).collect()) == len(ODD)
    assert mixing.mix_sources(empty).count() == 0
    assert mixing.apply_mix(odd).columns == odd.columns


def test_targets_are_capped(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 10), (None, 500)], "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # a weighs 5, b 2, c 1, null 5: a is cut at 30, c at 30, the rest is shared 2 to 5 and null is not cut.
    assert found == pytest.approx({"a": 30, "b": 1460 * 2 / 7, "c": 30, None: 1460 * 5 / 7})


def test_sharding(docs, odd, empty):
    rows = sharding.shard_documents(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    assert len(rows) == docs.count() and max(sizes.values()) <= 1.2 * min(sizes.values())
    for shard in sizes:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    texts = {r.doc_id: r.text for r in docs.collect()}
    homes = {}
    for r in rows:
        homes.setdefault(texts[r.doc_id], set()).add(r.shard)
        assert r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id].encode()) + 1
    assert all(len(shards) == 1 for shards in homes.values())
    assert sharding.shard_documents(odd).count() == len(ODD)
    assert sharding.shard_documents(empty).count() == 0


def test_sharding_levels(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROOT_UNITS", 300)
    monkeypatch.setattr(sharding, "BUCKET_UNITS", 400)
    monkeypatch.setattr(sharding, "BUCKET_BINS", 32)
    units = spark.range(2000).selectExpr("cast(id as string) unit", "id % 97 + 1 bytes", "id % 13 + 1 tokens", "1L rows")
    placed = sharding.assign_shards(units, 8).join(units, "unit").groupBy("shard").sum("bytes").collect()
    sizes = [r["sum(bytes)"] for r in placed]
    assert len(sizes) == 8 and max(sizes) <= 1.02 * min(sizes)


def _packed(payloads):
    return [gzip.compress(warc.build_record(i, None, p, None, False, "d"), mtime=0) for i, p in enumerate(payloads)]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    parts = [warc.build_record(i, None, b"page %d WARC/1.1 " % i * 50, None, False, "d") for i in range(4)]
    if packed:
        parts = _packed([b"page %d" % i * 50 for i in range(4)])
    whole = b"".join(parts)
    broken = bytearray(whole)
    broken[len(parts[0]) + len(parts[1]) // 2] ^= 0xFF
    found = list(warc.salvage(io.BytesIO(bytes(broken)), len(broken), packed))
    assert [x.fields["warc-record-id"][-2] for x in found if x.kind == "record"] == ["0", "2", "3"]
    assert [(x.start, x.end) for x in found if x.kind == "gap"] == [(len(parts[0]), len(parts[0]) + len(parts[1]))]
    assert list(warc.salvage(io.BytesIO(b""), 0, packed)) == []
    cut = whole[: len(whole) - len(parts[3]) // 2]
    found = list(warc.salvage(io.BytesIO(cut), len(cut), packed))
    assert sum(x.kind == "record" for x in found) == 3 and found[-1].kind == "gap" and found[-1].end == len(cut)


def _salvaged(data, packed):
    """Ids of the records, with a mark at doubtful ones, and the gaps."""
    found = list(warc.salvage(io.BytesIO(data), len(data), packed))
    edges = sorted({(x.start, x.end) for x in found})
    if found:
        assert edges[0][0] == 0 and edges[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(edges, edges[1:]))
    ids = [x.fields.get("warc-record-id", ":??").split(":")[-1][:-1] + "?" * x.doubtful for x in found if x.kind == "record"]
    return ids, [x for x in found if x.kind == "gap"]


def _noise(seed, size):
    return np.random.default_rng(seed).bytes(size)


def test_salvage_one_member_with_a_broken_record():
    parts = [warc.build_record(i, None, _noise(i, 2000), None, False, "d") for i in range(4)]
    inside = bytearray(b"".join(parts))
    inside[len(parts[0]) + len(parts[1]) // 2] ^= 0xFF
    ids, gaps = _salvaged(gzip.compress(bytes(inside), mtime=0), True)
    assert ids == ["0", "2", "3"]
    assert [g.inner for g in gaps] == [(len(parts[0]), len(parts[0]) + len(parts[1]))] and gaps[0].reason == "block digest"


@pytest.mark.parametrize("lost", [1, 5, 8])
def test_salvage_one_member_without_its_last_bytes(lost):
    whole = gzip.compress(b"".join(warc.build_record(i, None, _noise(i, 2000), None, False, "d") for i in range(4)), mtime=0)
    ids, gaps = _salvaged(whole[:-lost], True)
    assert ids == ["0", "1", "2", "3"] and [g.reason for g in gaps] == ["member cut short"]
    ids, gaps = _salvaged(whole[:-lost] + b"\xff" * lost, True)
    assert ids == ["0", "1", "2", "3"] and [g.reason for g in gaps] == ["member checksum or data"]


def test_salvage_keeps_what_was_unpacked_before_a_fault():
    long = [gzip.compress(b"".join(warc.build_record(i * 10 + k, None, _noise(k, 90_000), None, False, "d") for k in range(9))) for i in (1, 2)]
    broken = bytearray(long[0])
    broken[len(broken) // 2 : len(broken) // 2 + 40] = b"\xff" * 40
    ids, gaps = _salvaged(bytes(broken) + long[1], True)
    assert ids[:4] == ["10", "11", "12", "13"] and ids[-9:] == [str(n) for n in range(20, 29)] and gaps
    assert all(g.start == 0 and g.end == len(broken) for g in gaps)


def test_salvage_marks_a_record_inside_a_damaged_payload():
    embedded = warc.build_record(7, None, b"inner", None, False, "d")
    outer = bytearray(warc.build_record(1, None, b"x" * 50 + b"\r\n" + embedded + b"y" * 50, None, False, "d"))
    after = warc.build_record(2, None, b"after", None, False, "d")
    assert _salvaged(bytes(outer) + after, False)[0] == ["1", "2"]
    outer[outer.find(b"xxx")] ^= 1
    for packed in (False, True):
        data = bytes(outer) + after
        ids, gaps = _salvaged(gzip.compress(data, mtime=0) if packed else data, packed)
        assert ids == ["7?", "2"] and len(gaps) == 2


def test_salvage_wants_a_version_line():
    records = [warc.build_record(i, None, b"p" * 100, None, False, "d") for i in range(3)]
    false = records[1].replace(b"WARC/1.1", b"WARC/nonsense", 1)
    assert _salvaged(records[0] + false + records[2], False)[0] == ["0", "2"]
    # Damaged blank lines lose no record: not the one before them, nor the one behind.
    torn = records[0][:-4] + b"zzzz" + records[1]
    ids, gaps = _salvaged(torn, False)
    assert ids == ["0", "1"] and [(g.start, g.end) for g in gaps] == [(len(records[0]) - 4, len(records[0]))]
    bad = bytearray(torn)
    bad[len(records[0]) - 50] ^= 1
    assert _salvaged(bytes(bad), False)[0] == ["1"]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_long_records(packed):
    long = [warc.build_record(i, "u" * 200_000 * i, _noise(i, 1 << 20), None, False, "d") for i in range(3)]
    pack = (lambda r: gzip.compress(r, mtime=0)) if packed else (lambda r: r)
    parts = [pack(r) for r in long]
    assert _salvaged(b"".join(parts), packed) == (["0", "1", "2"], [])
    broken = bytearray(b"".join(parts))
    broken[len(parts[0]) + (900 << 10)] ^= 0x55
    ids, gaps = _salvaged(bytes(broken), packed)
    assert ids == ["0", "2"] and len(gaps) == 1
    # One rule for both kinds: a header ends within a megabyte.
    wide = pack(warc.build_record(3, "u" * (5 << 20), b"x", None, False, "d"))
    assert _salvaged(wide + parts[0], packed)[0] == ["0"]


def test_salvage_of_random_damage():
    parts = [warc.build_record(i, None, _noise(i, 300 + 40 * i), None, False, "d") for i in range(12)]
    for seed in range(60):
        draw, packed = random.Random(seed), seed % 2 == 0
        stored = [gzip.compress(p, mtime=0) for p in parts] if packed else parts
        data, hurt = bytearray(b"".join(stored)), set()
        for _ in range(3):
            at = draw.randrange(len(data))
            data[at] ^= draw.randrange(1, 256)
            hurt.add(next(i for i in range(12) if at < sum(map(len, stored[: i + 1]))))
        ids, _ = _salvaged(bytes(data), packed)
        assert {str(i) for i in range(12)} - {str(i) for i in hurt} <= {i.rstrip("?") for i in ids}


def test_warc_odd_rows(spark):
    pages = spark.createDataFrame(
        [(2, "u\r\nx", "same"), (1, None, "same"), (None, "u", "same"), (3, "u", None), (4, "u", "")], "page_id long, url string, html string"
    )
    found = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.archive_pages(pages).collect()}
    assert found == {(1, "response", None, 4), (2, "revisit", 1, 4), (None, "revisit", 1, 4), (3, "response", None, 0), (4, "revisit", 3, 0)}
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_token_counts(spark, odd, empty):
    coder = token_counts.encoder(token_counts.vocabulary_path())
    expected = Counter((r[0], len(coder.encode_ordinary(r[1] or ""))) for r in ODD)
    assert Counter(tuple(r) for r in token_counts.token_counts(odd).collect()) == expected
    assert token_counts.token_counts(empty).count() == 0


def test_separators_across_blocks(spark, tmp_path):
    rng = np.random.default_rng(0)
    tokens = rng.choice([7, 8, 9], 1000, p=[0.1, 0.6, 0.3]).astype("<u2")
    tokens[-1], tokens[0] = 8, 7
    (tmp_path / "a.u16").write_bytes(tokens.tobytes())
    (tmp_path / "b.u16").write_bytes(b"")
    files = spark.createDataFrame([(str(tmp_path / "a.u16"),), (str(tmp_path / "b.u16"),), (None,)], "path string")
    expected, run, place = [], 0, 0
    for t in tokens.tolist():
        if t == 7:
            expected.append((place, run, True))
            place, run = place + 1, 0
        else:
            run += 1
    expected.append((place, run, False))
    found = token_counts.scan_separators(files, 7, block_tokens=13).collect()
    assert sorted((r.place, r.n_tokens, r.ended) for r in found) == expected


def test_chat_round_trip(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<", "|>", "", None, "\n\n é日本🙂 ", "<<||", "\\", LONG]
    rows = [(1, i, "assistant" if i % 2 else "user", t, "x") for i, t in enumerate(nasty * 2)] + [(None, None, None, "a", "x")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    found = {r.conv_id: r for r in chat.chat_digests(chat.format_chats(given)).collect()}
    learnt = "".join(t or "" for _, i, role, t, _ in rows if role == "assistant")
    turns = "".join(f"{role}\n{t or ''}\n" for c, _, role, t, _ in rows if c == 1)
    assert found[1].loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest() and found[1].loss_chars == len(learnt)
    assert found[1].turns_sha256 == hashlib.sha256(turns.encode()).hexdigest() and found[1].n_turns == len(nasty) * 2
    assert found[None].n_turns == 1
    assert chat.chat_digests(chat.format_chats(given.limit(0))).count() == 0
    for text in [t for t in nasty if t]:
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)


def test_chat_tokens_are_those_of_another_encoder(docs):
    """The same vocabulary in another library, which reports offsets itself; it has the control strings added."""
    import public_tokenizers
    from tokenizers import AddedToken, Tokenizer

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.add_special_tokens([AddedToken(t, special=True, normalized=False) for t in (chat.START, chat.BODY, chat.END)])
    with open(chat.vocabulary_path(), "rb") as file:
        made = chat.coder(file.read(), chat.split_pattern())
    odd_texts = ["", " ", "é日本🙂‍👩", "\r\n \t", "<|endoftext|>", "don't we'LL 1234", "\u00a0\u3000x", "a" * 3000, "<|im_sep|>", "\x00"]
    for texts in [odd_texts, *[[r.text or ""] for r in docs.limit(40).collect()]]:
        turns = [(role, text) for text in texts for role in ("user", "assistant")]
        found, expected = chat.encode(turns, made), other.encode(chat.render(turns)[0], add_special_tokens=False)
        assert found["token_ids"].tolist() == expected.ids
        assert list(zip(found["token_starts"].tolist(), found["token_ends"].tolist())) == expected.offsets
        assert byte_pairs._piece_by_piece(made[0], found["formatted"]) == expected.ids


def test_runs_of_blanks_that_the_splitter_gives_up_on(spark):
    blanks = " " * 2_000_000 + "x" + "\n" * 1_000_000
    given = spark.createDataFrame([(1, 0, "assistant", blanks)], "conv_id long, turn long, role string, text string")
    found = chat.chat_digests(chat.format_chats(given)).first()
    assert (found.loss_chars, found.loss_sha256) == (len(blanks), hashlib.sha256(blanks.encode()).hexdigest())
    docs = spark.createDataFrame([(1, blanks), (2, "x")], "doc_id long, text string")
    counts = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs).collect()}
    encoding = token_counts.encoder(token_counts.vocabulary_path())
    assert counts == {1: len(byte_pairs._piece_by_piece(encoding, blanks)), 2: 1}


def test_classifiers(spark, odd, empty):
    source = "/root/testdata/sf0.01"
    given, labels = (spark.read.parquet(f"{source}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r for r in labels.collect()}
    rows = [r for r in quality.score_quality(given, labels).collect() if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id].quality for r in rows]) >= 0.95
    rows = toxicity.score_toxicity(given, labels).collect()
    assert len(rows) == given.count() and all(0 <= r.score <= 1 for r in rows)
    for score in (quality.score_quality, toxicity.score_toxicity):
        assert score(odd, labels).count() == len(ODD)
        assert score(odd, labels.limit(0)).count() == len(ODD)
        assert score(empty, labels).count() == 0


def test_toxic_words_share_their_parts():
    rng = np.random.default_rng(0)
    plain = [f"{a}{b}" for a in ("ban", "tor", "mel", "sul") for b in ("do", "ri", "ka", "ne")]
    texts = [" ".join(rng.choice(plain, 30)) for _ in range(300)]
    bad = [t + f" vequ{rng.choice(['do', 'ri'])}" * 2 for t in texts[:150]]
    table, bias = toxicity.train(bad + texts[150:], np.array([1] * 150 + [0] * 150))
    scorer = toxicity.Scorer(table, bias)
    assert scorer.logit(texts[0] + " vequka vequne") > scorer.logit(texts[0])


def test_isotonic_rises():
    at, share = quality.isotonic(np.arange(5.0), np.array([0, 2, 1, 3, 4]), np.full(5, 4.0))
    assert (np.diff(at) > 0).all() and (np.diff(share) >= 0).all()
    share = quality.isotonic(np.arange(2.0), np.array([0, 1]), np.array([1.0, 1000.0]))[1]
    assert (np.diff(share) >= 0).all()


def test_isotonic_against_the_minimax_formula():
    rng = np.random.default_rng(4)
    for _ in range(50):
        n = rng.integers(1, 12)
        counts = rng.integers(1, 50, n).astype(float)
        positives = np.array([rng.integers(0, c + 1) for c in counts], float)
        mean = lambda j, k: positives[j : k + 1].sum() / counts[j : k + 1].sum()
        expected = [max(min(mean(j, k) for k in range(i, n)) for j in range(i + 1)) for i in range(n)]
        pools = quality._pooled(np.column_stack([np.arange(n) * counts, positives, counts]))
        sizes = pools[:, 2]
        found = np.repeat(pools[:, 1] / sizes, _members(counts, sizes))
        assert np.allclose(found, expected)
        assert (np.diff(quality.isotonic(np.arange(n, dtype=float), positives, counts)[1]) >= 0).all()


def _members(counts, sizes):
    """How many of ``counts`` make up each of ``sizes``."""
    ends = np.searchsorted(np.cumsum(counts), np.cumsum(sizes) - 0.5) + 1
    return np.diff(np.append(0, ends))


def test_ids_beside_null_ids_keep_all_their_digits(spark):
    big = [2**53 + 1, 2**53 + 3, 2**62 + 1]
    rows = [(i, f"some words of text number {i} and more", "a") for i in big] + [(None, "no id at all", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.doc_id for r in quality.score_quality(df, labels).collect()} == {*big, None}
    assert {(r.doc_id, r.component_id) for r in near_dedup.near_dedup(df).collect()} == {(i, i) for i in [*big, None]}


@pytest.mark.parametrize("repeats", [30, 1000])
def test_mixing_of_a_repeated_row(spark, repeats):
    rows = [(1, "one two three four five", "a", i) for i in range(repeats)]
    rows += [(10 + i, "word " * (i % 7 + 1), "b" if i % 3 else None, i) for i in range(200)]
    rows += [(2, "same " * 4, "b", 7)] * 11
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, repeats long")
    mixed = mixing.mix_sources(df).collect()
    taken, targets, longest = Counter(), {}, Counter()
    for r in mixed:
        taken[r.source] += (r.copies * r.repeats + r.more) * r.size
        targets[r.source], longest[r.source] = r.target, max(longest[r.source], r.size)
    assert all(abs(taken[s] - t) <= longest[s] / 2 + 1e-6 for s, t in targets.items())
    applied = mixing.apply_mix(df)
    assert applied.columns == df.columns
    copies = Counter((r.doc_id, r.text, r.source, r.repeats) for r in applied.collect())
    there = Counter(rows)
    assert all(n <= 3 * there[row] for row, n in copies.items())
    words = Counter()
    for (_, text, source, _), n in copies.items():
        words[source] += n * len(text.split())
    assert words == Counter({s: n for s, n in taken.items() if n})


@pytest.mark.parametrize("percent", [50, 70, 80, 90])
def test_near_dedup_recall_by_similarity(spark, percent):
    """300 pairs just at the asked similarity: all but a few in a thousand have to be found."""
    assert 1000 * near_dedup.bands_for(percent).missed(percent) < 1
    size = 1 + 200 * percent // (100 + percent)  # shared words of two sets of 100 words for that similarity
    rows = []
    for i in range(300):
        shared = [f"s{i}x{k}" for k in range(size)]
        for j in range(2):
            rows.append((2 * i + j, " ".join(shared + [f"o{i}y{j}z{k}" for k in range(100 - size)])))
    found = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), width=1, percent=percent).collect()
    linked = sum(r.doc_id % 2 and r.component_id == r.doc_id - 1 for r in found)
    assert linked >= 298 and all(r.component_id in (r.doc_id, r.doc_id - 1) for r in found)


def test_columns_with_the_names_of_helpers(spark, docs):
    names = ["__key", "__row_key", "__copy", "__copies", "__score", "__source", "__more", "__place", "__rank", "__first", "more", "repeats"]
    odd = docs.limit(40).selectExpr("*", *[f"doc_id AS `{n}`" for n in names])
    for name, step in corpus_pipeline.STAGES[:-1]:
        made = step(spark, odd, SF_DIR)
        assert made.columns == odd.columns
        assert all(r[n] == r.doc_id for r in made.collect() for n in names), name


def test_pipeline_stages(spark, docs):
    current, names = docs, [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    for name, step in corpus_pipeline.STAGES[:-1]:
        made = step(spark, current, SF_DIR).cache()
        assert made.columns == docs.columns and 0 < made.count()
        known = {r.doc_id for r in current.collect()}
        ids = [r.doc_id for r in made.collect()]
        assert set(ids) <= known
        if name == "near_dedup":
            expected = _brute_components([(r.doc_id, r.text) for r in current.collect()], 5)
            assert sorted(ids) == sorted(d for d, (_, c) in expected.items() if c == d)
        current = made
    last = corpus_pipeline.STAGES[-1][1](spark, current, SF_DIR)
    assert last.count() == current.count()


def test_row_key_tells_null_from_empty(spark):
    rows = spark.createDataFrame([(1, None), (1, ""), (None, ""), (11, "t"), (1, "1t")], "doc_id long, text string")
    keys = [r[0] for r in rows.select(common.row_key(rows.doc_id, rows.text)).collect()]
    assert len(set(keys)) == 5
