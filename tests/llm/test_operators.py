"""Each operator against plain code, on the smallest tables and on a table of odd rows."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tallyspan.llm import (
    arc_warc, bloom_dedup, bpe, chunked_bpe, label_shards, mil_quality, partenum, suffix_refine, token_files, toxicity, winnowing,
)

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PASSAGE = "One shared passage goes on for thirteen words and some more until it ends here. "
LONG = "".join(f"w{k % 997}é " for k in range(30_000))
ODD = [
    (1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "one two"), (5, "one two"), (None, "one two"), (7, LONG),
    (8, PASSAGE * 9 + "tail"), (9, "HEAD 's " + PASSAGE * 8), (10, "x" * 900), (11, "it's <|endoftext|> we'll  \n go 漢字 😀"),
    (12, PASSAGE), (None, None), (14, LONG + "more"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "x", k, "clash") for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, row int, h string").repartition(3)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, key string")


@pytest.fixture(params=["odd", "small", "empty"])
def documents(request):
    return request.getfixturevalue(request.param)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def words(text, pattern):
    return re.findall(pattern, (text or "").translate(LOWER))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


def test_bpe_equals_the_library(documents, library):
    expected = []
    for i, t in pairs(documents):
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        expected.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert rows(chunked_bpe.token_digests(documents)) == sorted(expected, key=repr)


def test_pieces_equal_the_library_for_every_checked_character(library):
    codec = bpe.codec(bpe.default_path())
    texts = [f"a{c}b 1{c}{c} {c}\n{c}'s{c}'re {c}  x" for c in map(chr, range(0x2100))]
    raw = [t.encode() for t in texts]
    made = codec.encode(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))))
    assert [made.ids(k)[0] for k in range(len(texts))] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_chunks_are_reused():
    encoder = chunked_bpe.ChunkEncoder(bpe.codec(bpe.default_path()))
    raw = LONG.encode()
    buf = np.frombuffer(raw + b"other start " + raw, np.uint8)
    a, b = encoder.slice(buf, np.array([0, len(raw), len(buf)]))
    assert (a[1], b[1]) == (raw, b"other start " + raw)
    assert encoder.reused > encoder.encoded / 2


def test_token_files_round_trip(documents, library):
    texts = sorted(pairs(documents), key=lambda x: (x[0] is not None, x[0] or 0))
    got = [tuple(r) for r in token_files.round_trip(documents).collect()]
    lengths = {}
    for i, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        lengths.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert {k: sorted(v) for k, v in lengths.items()} == {k: sorted((n, c) for i, _, n, c in got if i == k) for k in lengths}
    got.sort(key=lambda r: r[1])
    assert [r[1] for r in got] == np.concatenate(([0], np.cumsum([r[2] for r in got])))[:-1].astype(int).tolist()
    assert [r[0] for r in got] == [i for i, _ in texts]


def test_one_document_of_a_token_file(spark, small, library, tmp_path):
    token_files.write_token_files(small, f"{tmp_path}/t")
    raw = token_files.read_dictionary(spark, f"{tmp_path}/t")
    files = spark.read.format("binaryFile").load(f"{tmp_path}/t/data").select("content").collect()
    found = [x for f in files for b in token_files.blocks(bytes(f[0])) if (x := b.document(17, raw))]
    text = small.where("doc_id = 17").first()["text"]
    assert found == [library.encode(text, add_special_tokens=False).ids + [2]]


def test_shingle_components(documents):
    docs = pairs(documents)
    sets = []
    for _, t in docs:
        w = words(t, r"[^\x20\x09-\x0D]+")
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and min(len(sets[a]), len(sets[b])) * 4 >= 3 * max(len(sets[a]), len(sets[b])):
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    parent[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(docs):
        least[find(k)] += [i] if i is not None else []
    expected = [(i, len(sets[k]), min(least[find(k)], default=None)) for k, (i, _) in enumerate(docs)]
    got = partenum.similarity_classes(documents).select("doc_id", "n_shingles", "component_id")
    assert rows(got) == sorted(expected, key=repr)


def test_linked_sets_share_a_signature():
    draw = np.random.default_rng(3)
    for size in (3, 4, 7, 11, 23, 24, 40, 95, 130, 300, 767, 1500):
        for _ in range(20):
            first = np.unique(draw.integers(0, 2**63, size).astype(np.uint64))
            n = len(first)
            cut = int(draw.integers(0, n // 4 + 1))
            extra = (4 * (n - cut) - 3 * n) // 3  # as many new shingles as a link allows
            second = np.unique(np.concatenate((first[cut:], draw.integers(0, 2**63, max(0, extra)).astype(np.uint64))))
            if not partenum.similarity(first, second)[1] or n == len(second) == len(first[cut:]):
                continue
            member, signature, band, _ = partenum.signatures(np.concatenate((first, second)), np.array([0, n, n + len(second)]))
            assert set(signature[member == 0].tolist()) & set(signature[member == 1].tolist()), (size, cut)


def test_outliers_of_large_families_are_linked(spark):
    draw = np.random.default_rng(5)
    docs = []
    for family, size in enumerate((185, 185, 250, 300, 380)):
        text = [f"t{family}x{k}" for k in range(size + 4)]
        variants = [list(text)]
        for k in range(50):
            variant = list(text)
            for at in draw.integers(0, len(text), int(draw.integers(1, 4))):
                variant[at] = f"v{family}x{k}x{at}"
            variants.append(variant)
        # J of 0.75 to 0.80 with the text alone
        variants += [text + [f"o{family}x{k}x{j}" for j in range(size // 3 - k * size // 100)] for k in range(8)]
        docs += [" ".join(v) for v in variants]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(str.split, docs)]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for k in range(len(docs)):
        least[find(k)].append(k)
    got = partenum.similarity_classes(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"))
    assert rows(got.select("doc_id", "component_id")) == sorted(((k, min(least[find(k)])) for k in range(len(docs))), key=repr)


def test_exact_groups(documents):
    docs = [(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in pairs(documents)]
    size, top = Counter(h for _, h in docs), {}
    for i, h in docs:
        top[h] = max(top.get(h, -1), -1 if i is None else i)
    got = bloom_dedup.duplicate_groups(documents).collect()
    assert Counter((r.doc_id, r.text_sha256, r.group_size) for r in got) == Counter((i, h, size[h]) for i, h in docs)
    assert all((-1 if r.keep_id is None else r.keep_id) == top[r.text_sha256] for r in got)
    kept = [r for r in got if r.kept]
    assert Counter(r.text_sha256 for r in kept) == Counter(size.keys()) and all(r.doc_id == r.keep_id for r in kept)
    left = bloom_dedup.drop_duplicates(documents)
    assert left.columns == documents.columns and left.count() == len(size)


def test_shards_are_even_and_gapless(documents):
    docs = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in pairs(documents))
    got = label_shards.shard_documents(documents, shards=7).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == docs
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [len(slots[k]) for k in range(7)]
    assert max(sizes) - min(sizes) <= 1


def test_label_propagation_gathers_groups(spark):
    df = spark.createDataFrame([(k, f"text {k if k % 3 else k % 60}") for k in range(3000)], "doc_id long, text string")
    got = label_shards.shard_documents(df, shards=10).collect()
    places = defaultdict(set)
    for r in got:
        places[(r.text_crc32, r["size"])].add(r.shard)
    assert sum(len(v) > 2 for v in places.values()) == 0
    assert {v for v in Counter(r.shard for r in got).values()} == {300}


def benchmark_hits(docs, items):
    windows, sizes = defaultdict(set), set()
    for i, t in items:
        w = words(t, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
        if w:
            sizes.add(n := min(13, len(w)))
            for k in range(len(w) - n + 1):
                windows[tuple(w[k : k + n])].add("" if i is None else str(i))
    for i, t in docs:
        w = words(t, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if x := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= x
        yield i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("items", ["given", "odd", "none"])
def test_contamination(spark, documents, items, monkeypatch):
    if items == "given":
        benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    else:
        rest = [(1, PASSAGE), (1, "two"), (None, "One TWO!"), (4, None), (5, "..."), (6, PASSAGE + "other"), (6, PASSAGE + "other")]
        benchmark = spark.createDataFrame(rest if items == "odd" else [], "item_id long, text string")
        monkeypatch.setattr(winnowing, "BROADCAST_ROWS", 1)
    expected = list(benchmark_hits(pairs(documents), [tuple(r) for r in benchmark.collect()]))
    assert rows(winnowing.contamination(documents, benchmark)) == sorted(expected, key=repr)
    clean = winnowing.drop_contaminated(documents, benchmark)
    assert clean.columns == documents.columns and clean.count() == sum(not x[-1] for x in expected)


def test_contamination_runs_no_python(spark, small):
    plan = winnowing.contamination(small, spark.read.parquet(f"{SF_DIR}/benchmark.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("bucket, length, q", [(suffix_refine.BUCKET, 60, 15), (1, 60, 15), (suffix_refine.BUCKET, suffix_refine.LENGTH, suffix_refine.Q)])
def test_repeated_strings(documents, bucket, length, q, monkeypatch):
    monkeypatch.setattr(suffix_refine, "BUCKET", bucket)
    docs, seen = pairs(documents), Counter()
    raw = [(t or "").encode() for _, t in docs]
    for b in raw:
        seen.update(b[k : k + length] for k in range(len(b) - length + 1))
    expected = []
    for (i, _), b in zip(docs, raw, strict=True):
        gone, till = bytearray(len(b)), 0
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[max(k, till) : k + length] = b"\1" * (k + length - max(k, till))
                till = k + length
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        expected.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest(), len(kept)))
    assert rows(suffix_refine.repeat_digests(documents, length, q)) == sorted(expected, key=repr)


def test_anchors_of_pieces_come_once(monkeypatch):
    draw = np.random.default_rng(7)
    buf, offsets = draw.integers(97, 123, 9_000).astype(np.uint8), np.array([0, 5_000, 5_050, 9_000])
    whole = [np.concatenate(c).tolist() for c in zip(*suffix_refine.anchors(buf, offsets, 60, 15), strict=True)]
    monkeypatch.setattr(suffix_refine, "PIECE", 113)
    parts = [np.concatenate(c).tolist() for c in zip(*suffix_refine.anchors(buf, offsets, 60, 15), strict=True)]
    assert parts == whole and len(set(zip(*whole[:2], strict=True))) == len(whole[0])


def test_long_texts_do_not_repeat_themselves(spark):
    draw = np.random.default_rng(9)
    text = draw.integers(97, 123, 5 << 18).astype(np.uint8).tobytes().decode()
    df = spark.createDataFrame([(1, text), (2, "head" + text[700_000:700_500])], "doc_id long, text string")
    got = [(r.doc_id, r.n_removed, r.n_spans) for r in suffix_refine.repeat_digests(df).collect()]
    assert sorted(got) == [(1, 500, 1), (2, 500, 1)]


def test_archives(spark):
    given = [(1, "http://a b/", "<p>x</p>"), (2, None, None), (3, "http://c/", ""), (4, "http://d/", "<p>x</p>"), (None, "u", "<p>x</p>"), (6, "http://e/", "WARC/1.1\r\n\r\n\n" * 3)]
    given += [(r["page_id"] + 100, r["url"], r["html"]) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()]
    pages = spark.createDataFrame(given, "page_id long, url string, html string")
    top = {}
    for i, _, h in given:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    expected = []
    for i, _, h in given:
        raw, own = (h or "").encode(), top[h or ""] == i
        expected.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if own else "revisit", None if own else top[h or ""]))
    assert rows(arc_warc.round_trip(pages)) == sorted(expected, key=repr)
    assert arc_warc.round_trip(pages.limit(0)).count() == 0


def test_arc_versions():
    for version in (1, 2):
        arc = arc_warc.arc_version_block(version, "n.arc", "20010203040506")
        arc += arc_warc.arc_record(version, "http://a/", "20010203040506", b"body\nwith lines", "n.arc", len(arc))
        ((header, body),) = arc_warc.parse_arc(arc)
        assert (header["URL"], header["Archive-date"], body) == ("http://a/", "20010203040506", b"body\nwith lines")
    assert arc_warc.iso_date("20010203040506") == "2001-02-03T04:05:06Z"
    with pytest.raises(ValueError):
        list(arc_warc.parse_arc(arc[:-5]))


@pytest.mark.parametrize("module, name, folds, held, least", [(toxicity, "toxic", 5, 0, 0.9), (mil_quality, "quality", 3, 1, 0.97)])
def test_held_out_accuracy(spark, module, name, folds, held, least):
    table = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{table}/{t}.parquet") for t in ("documents", "labels"))
    got = module.score_documents(docs, labels).collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    truth = {r["doc_id"]: r[name] for r in labels.collect()}
    right = [r.predicted == truth[r.doc_id] for r in got if r.held_out and truth.get(r.doc_id) is not None]
    assert np.mean(right) >= least
    # held-out labels teach nothing
    other = labels.where(f"pmod(crc32(cast(cast(doc_id as string) as binary)), {folds}) <> {held}")
    assert rows(module.score_documents(docs, other)) == sorted(map(tuple, got), key=repr)


@pytest.mark.parametrize("module, name", [(toxicity, "toxic"), (mil_quality, "quality")])
def test_scores_of_odd_rows(spark, odd, empty, module, name):
    labels = spark.createDataFrame([(k, k % 2, "x") for k in range(15)] + [(None, 1, "x"), (3, None, "x")], f"doc_id long, {name} int, text string")
    got = module.score_documents(odd, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert module.score_documents(odd, labels.limit(0)).count() == len(ODD)
    assert module.score_documents(empty, labels).count() == 0


def test_every_byte_of_a_word_is_spelled():
    texts = ["", "a", "x" * 29, "x" * 30, "x" * 31, "ab " + "漢字" * 40 + ", " + "y" * 90, "Ж" * 50]
    raw = [t.encode() for t in texts]
    buf, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    out, places, text, begin, first, end, _ = toxicity.units(buf, offsets)
    given = np.zeros(len(out), int)
    for a, b in zip(first, end, strict=True):
        given[a:b] += 1
    assert given.tolist() == [int(c != 32 or (k > 0 and out[k - 1] != 32)) for k, c in enumerate(out)]
    assert all(out[a] == 32 or f - a == toxicity.CONTEXT for a, f in zip(begin, first, strict=True))
    # Chinese characters are words of their own
    assert Counter(text.tolist()) == {1: 1, 2: 1, 3: 2, 4: 2, 5: 1 + 80 + 1 + 4, 6: 4}


def test_long_runs_are_read_to_their_end(spark):
    draw = np.random.default_rng(13)
    usual = ["".join(chr(0x4E00 + c) for c in draw.integers(0, 300, 2)) for _ in range(40)]
    docs = []
    for k in range(1000):
        text = [usual[c] for c in draw.integers(0, 40, 40)]
        if k % 2:
            text[20] = "汚語悪罵"
        docs.append((k, "".join(text)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1000)], "doc_id long, toxic int")
    got = [r for r in toxicity.score_documents(df, labels).collect() if r.held_out]
    assert np.mean([r.predicted == r.doc_id % 2 for r in got]) >= 0.9


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        given, docs = {r.doc_id: r.text for r in docs.collect()}, spark.read.parquet(f"{tmp_path}/{name}")
        left = {r.doc_id: r.text for r in docs.collect()}
        assert left.items() <= given.items() and len(left) == docs.count()
        if name == "exact_dedup":
            assert set(left) == {max(i for i in given if given[i] == t) for t in given.values()}
        if name == "benchmark_decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            assert set(left) == {x[0] for x in benchmark_hits(given.items(), items) if not x[-1]}
    assert 0 < docs.count() < before
    final = corpus_pipeline.run(spark, SF_DIR)
    assert rows(final.select("doc_id")) == rows(docs.select("doc_id"))
    assert pq.ParquetDataset(f"{tmp_path}/toxicity").read().num_rows < before
