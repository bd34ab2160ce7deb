"""Brute-force versions, round trips and edge cases of the training-data operators."""

import base64
import gzip
import hashlib
import io
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.compare import rows, views
from vocabmill.llm import common, decontaminate, jaccard, licenses, lines, passages, pieces, toxicity, vectors, warc, wavelet

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def con():
    return views(SF)


def docs(spark, texts, extra=False):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], DOCS)
    return d.withColumns({"n_words": F.lit("x"), "score": F.lit(1), "line": F.lit(2), "key": F.lit(3)}) if extra else d


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


@pytest.mark.parametrize("name", ["op1_decontaminate", "op2_warc", "op4_jaccard", "op5_licenses", "op9_vectors", "op10_lines"])
def test_against_sql(spark, con, name):
    from vocabmill.llm.queries import ORACLE_SQL, QUERIES

    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(con.execute(ORACLE_SQL[name]).df())


# ---------------------------------------------------------------- words


def test_words():
    texts = ["Hello WORLD, é9 x", None, "", "a b", " b\ta\n", "É Ça", "x" * 5000]
    data, offsets = common.buffers(pa.array(texts))
    for kind, pattern in ((common.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (common.SPACED, r"[^\x20\x09-\x0D]+")):
        w = common.Words(data, offsets, kind)
        for i, t in enumerate(texts):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
            assert [w.text(k).decode() for k in range(w.first[i], w.first[i + 1])] == re.findall(pattern, low)


def test_own_columns_stay(spark):
    """Columns that the operators name for themselves."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    d = docs(spark, ["a b c " * 40, "one", None]).withColumn("_row", F.lit("mine"))
    assert {r._row for r in pieces.encode(d, model, 16, merges=True).collect()} == {"mine"}
    items = spark.createDataFrame([(1, "a b c a b c"), (2, "one")], "item_id bigint, text string")
    got = decontaminate.scan(d.withColumn("_items", F.lit(7)), items, 3, 4).collect()
    assert {(r._row, r._items) for r in got} == {("mine", 7)} and sorted(r.n_hit for r in got) == [0, 1, 120]


@pytest.mark.parametrize("one_task", [0, 1 << 16])
def test_components(spark, monkeypatch, one_task):
    monkeypatch.setattr(common, "ONE_TASK", one_task)
    rng = random.Random(2)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(200, 230)] + [(500, k) for k in range(501, 560)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {(r.node, r.component) for r in common.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {(x, find(x)) for x in root if any(x in p and p[0] != p[1] for p in links)}
    assert common.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# ---------------------------------------------------------------- 1


def brute_hits(text, items, window):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    w, hit, found = words(text), set(), set()
    for name, t in items:
        v = words(t)
        n = min(window, len(v))
        grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add(name)
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("most", [400_000, 12])
def test_decontaminate_random(spark, most):
    rng = random.Random(7)
    text = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    items = [(f"i{k}", text(rng.randrange(0, 14))) for k in range(12)] + [("same", "a b a b a b"), ("same", "c c c c"), ("none", None), ("dots", "... !!")]
    texts = [text(rng.randrange(0, 60)) for _ in range(40)] + [None, "", "...", "A. B, a-b A b!"]
    found = decontaminate.scan(docs(spark, texts, True).withColumnRenamed("n_words", "hits"), spark.createDataFrame(items, "item_id string, text string"), window=4, most=most)
    got = by_id(found, "n_hit", "items")
    for i, t in enumerate(texts):
        _, n, names = brute_hits(t, items, 4)
        assert got[i] == (n, names), (i, t)


def test_decontaminate_clean(spark):
    item = "one two three four five six seven eight nine ten eleven"
    texts = [f"Héllo there my friend of many long words, {item}! And so on and on it goes for long.", item, "plain", None]
    out = by_id(decontaminate.clean(docs(spark, texts), spark.createDataFrame([(1, item)], "item_id bigint, text string")), "text")
    assert out == {0: ("Héllo there my friend of many long words, ! And so on and on it goes for long.",), 2: ("plain",), 3: (None,)}
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert by_id(decontaminate.clean(docs(spark, texts), empty), "text")[1] == (item,)
    assert decontaminate.scan(docs(spark, []), empty).count() == 0


# ---------------------------------------------------------------- 2


def test_warc(spark, tmp_path):
    pages = [(1, "http://a/1", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u\r\nx", None), (4, "u", ""), (5, "u", "z" * 300_000), (5, "u", "z" * 300_000), (None, "n", "<p>é</p>")]
    p = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("digest", F.lit(1)).withColumn("keep", F.lit(2))
    paths = warc.write_warc(p, f"file://{tmp_path}/w")
    all_ = warc.read_warc(spark, paths)
    got = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes, None if r.payload is None else bytes(r.payload)) for r in all_.collect())
    e = "<p>é</p>".encode()
    assert got == [(0, "revisit", "2", len(e), None), (1, "revisit", "2", len(e), None), (2, "response", None, len(e), e), (3, "revisit", "4", 0, None), (4, "response", None, 0, b""), (5, "response", None, 300_000, b"z" * 300_000), (5, "response", None, 300_000, b"z" * 300_000)]
    digest = base64.b32encode(hashlib.sha1(e).digest()).decode()
    assert all_.where(F.col("payload_digest") == digest).count() == 3
    only = warc.read_warc(spark, paths, payload=False).where("record_type = 'response' and page_id in (2, 4)")
    assert {(r.page_id, r.payload) for r in only.collect()} == {(2, None), (4, None)}
    split = spark.read.format("warc").option("paths", "\n".join(paths)).option("splitBytes", "200").load()
    assert split.count() == 7 and split.rdd.getNumPartitions() > len(paths)
    with gzip.open(paths[0].removeprefix("file://")) as f:  # any gzip reader can read an archive
        assert f.read(8) == b"WARC/1.1"
    assert warc.read_warc(spark, warc.write_warc(p.limit(0), f"file://{tmp_path}/none")).count() == 0


def test_warc_of_others(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nhello"
    rec = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
    (tmp_path / "a.warc").write_bytes(rec * 2)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(rec) * 3)
    got = [bytes(r.payload) for r in warc.read_warc(spark, [str(tmp_path)]).collect()]
    assert got == [b"hello"] * 5


# ---------------------------------------------------------------- 3


def test_wavelet_file():
    ids = np.random.default_rng(1).integers(0, 50257, 70_000).astype(np.uint16) % 300
    out = io.BytesIO()
    wavelet.dump(out, ids, [7, None], np.array([69_999, 1]), 2)
    out.seek(0)
    m = wavelet.WaveletMatrix(out)
    assert (m.tokens() == ids).all() and m.documents()[0] == [7, None]
    for i in (0, 65_535, 65_536, 69_999):
        assert m.access(i) == ids[i]
    for token in (int(ids[3]), 299, 50_000):
        at = np.flatnonzero(ids == token)
        assert m.count(token) == len(at) and m.rank(token, 1000) == (at < 1000).sum()
        for j in (0, len(at) // 2, len(at) - 1):
            if len(at):
                assert m.select(token, j) == at[j]
    wavelet.dump(out := io.BytesIO(), ids[:0], [], np.zeros(0, np.int64), 2)
    out.seek(0)
    assert len(wavelet.WaveletMatrix(out).tokens()) == 0


def test_wavelet_shards(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    rng = random.Random(3)
    alphabet = ["a", "Bc", " ", "  ", "\n", "\t", "\r\n", "é", "1", "'s", "!", "日本", "\x1c", "\x85", "\xa0", "_", "😀", "<|endoftext|>", "x́", "  "]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 30))) for _ in range(300)] + [None, "", "word " * 3000]
    order = list(range(len(texts)))
    rng.shuffle(order)
    d = spark.createDataFrame([(i, texts[i]) for i in order], DOCS).withColumn("path", F.lit(1)).repartition(5)
    got = by_id(wavelet.read_shards(spark, wavelet.write_shards(d, f"file://{tmp_path}/s", path)), "start", "n_tokens", "ids_crc32")
    start = 0
    for i, x in enumerate(texts):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 2]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), x
        start += len(ids)
    assert wavelet.read_shards(spark, wavelet.write_shards(d.limit(0), f"file://{tmp_path}/e", path)).count() == 0


# ---------------------------------------------------------------- 4


def brute_jaccard(texts, size, percent):
    def grams(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()

    sets, root = [grams(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


@pytest.mark.parametrize("alphabet", [3, 6, 40])
def test_jaccard_random(spark, alphabet, monkeypatch):
    """Few words make crowded regions without much in common, so cells join several times over."""
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    monkeypatch.setattr(jaccard, "PER_SALT", 2)
    monkeypatch.setattr(jaccard, "LEAF", 4)
    rng = random.Random(alphabet)
    base = [" ".join(str(rng.randrange(alphabet)) for _ in range(rng.randrange(1, 30))) for _ in range(25)]
    texts = list(base)
    for b in base:
        for _ in range(3):
            w = b.split()
            w[rng.randrange(len(w))] = str(rng.randrange(alphabet))
            texts.append(" ".join(w))
    texts += [base[0], base[0].upper(), None, "", " \n", "one", "One"]
    want = brute_jaccard(texts, 2, 75)
    got = by_id(jaccard.jaccard_components(docs(spark, texts, True), size=2), "n_shingles", "component_id")
    assert got == want


def test_jaccard_windows(spark):
    """Chains: each text is linked with the next only, at and just below the bound."""
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[k * 10 : k * 10 + 100]) for k in range(12)] + [" ".join(words[k * 13 : k * 13 + 100]) for k in range(20, 23)] + ["hot phrase of five words " * 3] * 4
    assert by_id(jaccard.jaccard_components(docs(spark, texts)), "n_shingles", "component_id") == brute_jaccard(texts, 5, 75)


def test_jaccard_half_hashes():
    a = np.sort(np.random.default_rng(0).integers(0, 1 << 63, 5000, dtype=np.uint64))
    b = np.sort(np.concatenate([a[:4000], np.random.default_rng(1).integers(0, 1 << 63, 200, dtype=np.uint64)]))
    for wide in (False, True):
        n, slack = jaccard.common(jaccard.unpacked(jaccard.packed(a, wide)), jaccard.unpacked(jaccard.packed(b, wide)))
        assert 4000 <= n <= 4000 + slack and (slack == 0) == wide
    n, _ = jaccard.common(jaccard.unpacked(jaccard.packed(a[:100], False)), jaccard.unpacked(jaccard.packed(b, False)))
    assert n == 100


def test_jaccard_edges(spark):
    assert jaccard.jaccard_components(docs(spark, [])).count() == 0
    d = spark.createDataFrame([(1, "a b c"), (1, "x y z"), (2, "X y z"), (None, "a b c"), (3, "a b c")], DOCS)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jaccard.jaccard_components(d).collect())
    assert got == [(0, 1, 0), (1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]
    assert sorted(r.doc_id or 0 for r in jaccard.one_of_each(d).collect()) == [0, 1, 1]


# ---------------------------------------------------------------- 5


def test_licenses(spark):
    texts = ["MIT License mit license, MIT-license", "Released under the GPL: general public license\nLicensed under the Apache License, Version 2.0.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated", None, "", "smit license", "x " * 2000 + "mit license"]
    got = by_id(licenses.scan(docs(spark, texts, True)), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    assert got[0][:6] == (6, 3, 0, 4, "mit", "mit")
    assert got[1][1:6] == (2, 4, 10, "apache,gpl", "apache,apache-notice,gpl")
    assert got[2][1] == 0 and got[2][5] == "mit-grant" and got[2][6] == pytest.approx(17 / 19)
    assert got[3] == got[4] == (0, 0, None, None, "", "", 0.0) and got[5][1] == 0 and got[6][2] == 2000
    assert licenses.scan(docs(spark, [])).count() == 0


def test_licenses_wrapped(spark):
    mit = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction"""
    bsd = """Copyright x\n\n * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions are met:\n *\n * 1. Redistributions"""
    texts = [f"x y\n{mit}\nz", bsd, "This work is licensed under the GNU\nGeneral Public\nLicense version 3", "\n".join(licenses.TEMPLATES[1][1].split()), "with or without\nmodification of any copy"]
    got = by_id(licenses.scan(docs(spark, texts, True)), "labels", "score")
    assert [got[i][0] for i in range(5)] == ["mit-grant", "bsd-grant", "gpl,gpl-notice", "mit-grant", ""] and all(got[i][1] == 1 for i in range(4))


@pytest.mark.parametrize("threshold", [0.5, 0.85, 1.0])
def test_licenses_brute(spark, threshold):
    """Every line and template that meet the threshold, and none besides, whatever the order of the words."""
    rng = random.Random(4)
    own = [t.split() for _, t in licenses.TEMPLATES]
    line = lambda: " ".join(rng.sample(t := rng.choice(own), rng.randrange(len(t) // 2, len(t) + 1)) + rng.choices(["x", "License", "license", "of", "4", "9"], k=rng.randrange(4)))
    texts = ["\n".join(line() for _ in range(rng.randrange(4))) for _ in range(60)]
    d = docs(spark, texts)
    count = licenses.order_of(licenses.base_scan(d), licenses.TEMPLATES)
    assert count["license"] == sum("license" in t.lower().split() for t in texts)
    got = licenses.template_join(d, count, threshold=threshold).where("not wrapped").collect()
    want = set()
    for i, t in enumerate(texts):
        for k, x in enumerate(t.split("\n")):
            for label, template in licenses.TEMPLATES:
                w = set(template.split())
                if len(w & set(x.lower().split())) >= threshold * len(w) - 1e-9:
                    want.add((i, k, label))
    assert sorted((r.doc_id, r.block, r.label) for r in got) == sorted(want) and want


# ---------------------------------------------------------------- 6


def best_score(p, text):
    best = [0] + [-(1 << 60)] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(max(0, j - p.width), j):
            s = p.score.get(text[i:j])
            if s is not None:
                best[j] = max(best[j], best[i] + s)
        if text[j - 1] not in p.score:
            best[j] = max(best[j], best[j - 1] + pieces.BYTE_SCORE * len(text[j - 1].encode()))
    return best[-1]


def score_of(p, ids):
    total = 0
    for i in ids:
        total += pieces.BYTE_SCORE if i in p.bytes.values() else p.score[p.names[i]]
    return total


@pytest.mark.parametrize("chunk", [1 << 14, 40, 7])
def test_pieces(spark, chunk):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    p, sp = pieces.pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(11)
    parts = ["the", "ing", " ", "  ", "\n", "é", "日本", "😀", "internationalization", "x", "     ", "\t", "Qz", "☃"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 60))) for _ in range(25)] + [None, "", " ", "a" * 300, "nospace" * 60, " " * 90]
    coded = pieces.encode(docs(spark, texts, True), path, chunk)
    checked = by_id(pieces.encode(docs(spark, texts), path, chunk, check=True), "round_trip")
    assert all(checked[i] == (True,) or pieces.BLANK in (t or "") for i, t in enumerate(texts))
    got = by_id(pieces.decode(coded, path), "ids", "decoded")
    for i, t in enumerate(texts):
        ids, back = got[i]
        assert back == (t or "")
        if t:
            assert score_of(p, ids) == best_score(p, pieces.marked(t)), t
            assert sp.decode(ids) == t or sp.decode(ids) == t.removeprefix(" ")
    one, other = (sorted(map(tuple, x.collect())) for x in (pieces.described(coded, path), pieces.round_trip(docs(spark, texts), path, chunk)))
    assert one == other and all(x[3] for x in one)
    assert pieces.encode(docs(spark, []), path, chunk).count() == 0


@pytest.mark.parametrize("chunk", [1 << 14, 40])
def test_pieces_are_the_library_s(spark, chunk):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(12)
    parts = ["the", "ing", " ", "  ", "\n", "é", "日本", "😀", "internationalization", "x", "     ", "\t", "Qz", "☃", pieces.BLANK]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 60))) for _ in range(40)] + ["released under the mit license", None, "", " ", "a" * 300, "nospace" * 60, " " * 90]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    got = by_id(pieces.encode(docs(spark, texts, True), path, chunk, merges=pieces.by_merges(path)), "ids")
    for i, t in enumerate(texts):
        assert list(got[i][0]) == sp.encode(t or ""), t
    query = {r.doc_id: r for r in pieces.op6_pieces(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        assert query[r.doc_id].ids_crc32 == zlib.crc32(np.array(sp.encode(r.text or ""), "<i4").tobytes()) and query[r.doc_id].same_text


def test_max_plus_is_associative():
    rng = np.random.default_rng(4)
    a, b, c = (rng.integers(-50, 0, (5, 5)).astype(np.int64) for _ in range(3))
    assert (pieces.plus(pieces.plus(a, b), c) == pieces.plus(a, pieces.plus(b, c))).all()
    m = pieces.plus(pieces.plus(a, b), c)[0][0]
    path = pieces.states([a, b, c])
    assert sum(int(x[s, z]) for x, (s, z) in zip((a, b, c), path, strict=True)) == m


# ---------------------------------------------------------------- 7


def test_passages(spark):
    long = "One two three four five six seven eight nine. Aye! Ten eleven twelve e thirteen fourteen fifteen sixteen seventeen eighteen!"
    texts = [f"Intro here. {long} End.", f"Other é words {long.upper()}\nshort one. tail", None, "", "a b. a b. a b.", long, "x" + " w" * 30000, long]
    d = docs(spark, texts, True).withColumn("_id", F.lit("own"))
    assert {r._id for r in passages.dedup(d, 8, name="t").collect()} == {"own"}
    got = sorted((r.doc_id, r.start, r.end, r.kept_doc_id, r.kept_start) for r in passages.repeats(docs(spark, texts, True), 8).collect())
    raw = [(t or "").encode() for t in texts]
    assert [(d, raw[d][a:b].decode()[:3], k) for d, a, b, k, _ in got] == [(1, "AYE", 0), (1, "TEN", 0)] + [(k, x, 0) for k in (5, 7) for x in ("One", "Aye", "Ten")]
    assert {r.doc_id for r in passages.repeats(docs(spark, texts)).collect()} == {5, 7}  # 12 words of the second text are too few
    twice = spark.createDataFrame([(1, "a b c d."), (2, "a b c d."), (2, "a b c d."), (None, "a b c d.")], DOCS)
    assert [(r.doc_id, r.kept_doc_id) for r in passages.repeats(twice, 4).collect()] == [(1, None), (2, None), (2, None)] and not passages.repeats(twice, 5).count()
    out = by_id(passages.dedup(docs(spark, texts), 8, name="t"), "text", "removed")
    assert out[1][0] == "Other é words ONE TWO THREE FOUR FIVE SIX SEVEN EIGHT NINE.  \nshort one. tail" and len(out[1][1]) == 2
    assert out[3] == ("", None) and out[4][0] == texts[4] and out[2] == (None, None)
    assert passages.repeats(docs(spark, [])).count() == 0


def test_passages_brute(spark):
    from vocabmill.llm.queries import QUERIES

    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").toPandas().sort_values("doc_id")
    first, want = {}, set()
    for doc_id, text in zip(d.doc_id, d.text, strict=True):
        raw = (text or "").encode()
        low = bytes(c + 32 if 65 <= c <= 90 else c for c in raw)
        unit, seen = [], []
        found = list(re.finditer(rb"[0-9a-z\x80-\xff]+", low))
        for k, m in enumerate(found):
            gap = raw[found[k - 1].end() : m.start()] if k else b""
            if k and re.search(rb"\n|[.!?][ \t-\r]", gap):
                unit = close(unit, doc_id, first, seen)
            unit.append((m.start(), m.end(), m[0]))
        if unit:
            close(unit, doc_id, first, seen)
        for repeated, run in itertools.groupby(seen, key=lambda x: x is not None):
            run = list(run)
            if repeated and sum(x[2] for x in run) >= 20:
                want |= set(run)
    assert {(r.doc_id, r.start, r.n_words, r.kept_doc_id, r.kept_start) for r in QUERIES["op7_passages"](spark, SF).collect()} == want and want


def close(unit, doc_id, first, found):
    key = tuple(w for _, _, w in unit)
    found.append((doc_id, unit[0][0], len(key), *first[key]) if key in first else None)
    first.setdefault(key, (doc_id, unit[0][0]))
    return []


# ---------------------------------------------------------------- 8


def test_toxicity(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    texts, labels = [], []
    for i in range(1500):
        w = [rng.choice(words) for _ in range(40)]
        insult, group = rng.random() < 0.4, rng.random() < 0.4  # only both together are toxic
        w += ["insultword"] * insult + ["groupword"] * group
        rng.shuffle(w)
        texts.append(" ".join(w))
        labels.append(int(insult and group))
    texts += [None, "", "w1 " * 30_000]
    d = docs(spark, texts, False)
    y = spark.createDataFrame([*enumerate(labels), (3, None), (9_999, 1)], "doc_id bigint, toxic int")
    m = toxicity.train(d, y)
    got = by_id(toxicity.score(d, m), "score")
    held = [i for i in range(1500) if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum((got[i][0] >= 0.5) == bool(labels[i]) for i in held) / len(held)
    assert right > 0.97 and got[1500] == got[1501] and 0 <= got[1502][0] <= 1
    assert {r.doc_id for r in d.where(toxicity.held_out(F.col("doc_id"))).collect()} == {i for i in range(1503) if zlib.crc32(str(i).encode()) % 3 == 1}
    none = toxicity.train(d, y.where("toxic = 0"))
    assert max(x[0] for x in by_id(toxicity.score(d.limit(5), none), "score").values()) < 0.01
    assert toxicity.score(docs(spark, []), m).count() == 0


def test_toxicity_held_out(spark):
    """On the driver's documents, labels that were held out are met."""
    sf = "/root/testdata/sf0.1"
    got = toxicity.op8_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    n = got.agg(F.sum("toxic").alias("p"), F.sum(F.expr("toxic * predicted")).alias("hit"), F.sum(F.expr("(1 - toxic) * predicted")).alias("false"), F.count(F.lit(1)).alias("n")).first()
    assert n.hit / n.p > 0.75 and n.false / (n.n - n.p) < 0.03


def test_toxicity_pairs():
    """A score is the bias, the weights of the document's distinct terms and the products of the factors of every two of them."""
    texts = ["you awful lot", "Those people are awful, awful!", "", "nothing known here"]
    data, offsets = common.buffers(pa.array(texts))
    words = common.Words(data, offsets, common.ALNUM)
    owner, term = toxicity.terms(words)
    rng = np.random.default_rng(3)
    ids = np.unique(term[owner < 2])[::2]
    m = toxicity.Machine(ids, -0.3, rng.normal(size=len(ids)), rng.normal(size=(len(ids), 4)))
    want = []
    for i in range(len(texts)):
        k = [int(np.flatnonzero(ids == x)[0]) for x in sorted(set(term[owner == i].tolist())) if x in ids]
        z = -0.3 + sum(m.w[a] for a in k) + sum(float(m.v[a] @ m.v[b]) for n, a in enumerate(k) for b in k[:n])
        want.append(1 / (1 + np.exp(-z)))
    assert np.allclose(m.score(words), want) and len(set(want)) > 2


def test_toxicity_repeats(spark):
    d = docs(spark, ["you idiots", "you idiots", None, "", "x " * 200000], True)
    m = toxicity.Machine(np.zeros(0, np.int64), -1.0, np.zeros(0), np.zeros((0, 4)))
    got = toxicity.score(d, m).collect()
    assert len(got) == 5 and len({r.score for r in got}) == 1 and {r.n_words for r in got} == {"x"}


# ---------------------------------------------------------------- 9


def brute_vectors(data, bound):
    root, links = list(range(len(data))), [0] * len(data)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    good = [v is not None and lab is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v) for v, lab in data]
    for i, (a, la) in enumerate(data):
        for j in range(i):
            b, lb = data[j]
            if good[i] and good[j] and la == lb and np.dot(a, b) / (np.sqrt(np.dot(a, a)) * np.sqrt(np.dot(b, b))) >= bound:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (links[i], find(i), find(i) == i) for i in range(len(data))}


@pytest.mark.parametrize("per_cell,block", [(4000, 4096), (20, 16)])
def test_vectors(spark, monkeypatch, per_cell, block):
    monkeypatch.setattr(vectors, "PER_CELL", per_cell)
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(12, 6))
    data = [((centre[k % 12] + rng.normal(size=6) * s).tolist(), k % 2) for k in range(200) for s in (0.15,)] + [(centre[0].tolist(), 0)] * 30
    data += [([1.0, 0.0, 0.0, 0.0, 0.0, 0.0], 3), ([2.0, 0.0, 0.0, 0.0, 0.0, 0.0], 3), ([1.0, 0.0, 0.0, 0.0, 0.0, 0.0], None), (None, 3), ([0.0] * 6, 3), ([float("nan")] + [1.0] * 5, 3), ([None] + [1.0] * 5, 3), ([float("inf")] + [1.0] * 5, 3), ([], 3)]
    df = spark.createDataFrame([(i, v, lab) for i, (v, lab) in enumerate(data)], "vec_id bigint, embedding array<double>, label int").withColumn("home", F.lit(1)).repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_dedup(df).collect()}
    assert got == brute_vectors(data, 0.93)


def test_vectors_empty(spark):
    assert vectors.near_dedup(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0


# ---------------------------------------------------------------- 10


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_lines(texts):
    all_ = [(i, k, t.lower().split()) for i, x in enumerate(texts) for k, t in enumerate((x or "").split("\n"))]
    return {(i, k) for p, (i, k, w) in enumerate(all_) if len(w) >= lines.MIN_WORDS and any(v == w or len(v) >= lines.NEAR_WORDS and len(w) >= lines.NEAR_WORDS and near(v, w) for _, _, v in all_[:p])}


def test_lines(spark):
    rng = random.Random(8)
    base = [[rng.choice("abcdefg") for _ in range(rng.choice([2, 3, 7, 8, 9, 12, 40]))] for _ in range(30)]
    texts = []
    for _ in range(60):
        out = []
        for _ in range(rng.randrange(0, 5)):
            w = list(rng.choice(base))
            for _ in range(rng.randrange(0, 3)):
                k, what = rng.randrange(len(w)), rng.randrange(3)
                w[k : k + (what > 0)] = [rng.choice("abcXYZ")] * (what < 2)
                w = w or ["a"]
            out.append(rng.choice([" ", "  ", "\t"]).join(w))
        texts.append("\n".join(out))
    texts += [None, "", "a a a a a a a a a", "a a a a a a a a", "w " * 3000, "w " * 2999 + "v"]
    got = {(r.doc_id, r.line) for r in lines.duplicates(docs(spark, texts, True)).collect()}
    assert got == brute_lines(texts) and got
    kept = by_id(lines.dedup(docs(spark, texts)), "text")
    for i, t in enumerate(texts):
        left = [x for k, x in enumerate((t or "").split("\n")) if (i, k) not in got]
        if any(d == i for d, _ in got) and not "".join(left).strip():
            assert i not in kept
        else:
            assert kept[i] == (t if t is None else "\n".join(left),)


def brute_all_lines(texts):
    """Every line with words; an edit must leave more than half of the longer line's words."""
    all_ = [(i, k, t.lower().split()) for i, x in enumerate(texts) for k, t in enumerate((x or "").split("\n"))]
    return {(i, k) for p, (i, k, w) in enumerate(all_) if w and any(v == w or max(len(v), len(w)) > 2 and v and near(v, w) and 2 * (max(len(v), len(w)) - 1) > max(len(v), len(w)) for _, _, v in all_[:p])}


def test_short_lines(spark):
    rng = random.Random(9)
    texts = ["\n".join(" ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.choice([0, 1, 2, 2, 3, 3, 4, 5, 7]))) for _ in range(rng.randrange(0, 4))) for _ in range(150)]
    texts += ["Read more", "read  more\n \nRead all", "Share this page now", "share that page now", "share page now", None, "", "\t\n  \n", "Menu", "menu"]
    got = {(r.doc_id, r.line) for r in lines.duplicates(docs(spark, texts, True), **lines.WHOLE).collect()}
    assert got == brute_all_lines(texts) and got
    d = spark.read.parquet(f"{SF}/documents.parquet").sort("doc_id").collect()
    query, want = by_id(lines.op10_lines(spark, SF), "gone"), brute_all_lines([r.text for r in d])
    assert query == {r.doc_id: (",".join(str(k) for k in sorted(k for n, k in want if n == i)),) for i, r in enumerate(d)}


def test_lines_edges(spark):
    assert lines.duplicates(docs(spark, [])).count() == 0
    d = spark.createDataFrame([(1, "one two three"), (1, "one two three"), (None, "one two three"), (2, "One  two three")], DOCS)
    assert sorted((r.doc_id, r.line) for r in lines.duplicates(d).collect()) == [(1, 0), (2, 0)]


def test_lines_leave_no_tables(spark):
    """Only the table that the result reads stays; the result can be read again, and two calls don't meet."""
    from pathlib import Path

    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = {p for p in folder.rglob("*.parquet")}
    got = [lines.dedup(docs(spark, ["one two three\nfour", "one two tree", "one two three"]), "kept", **lines.WHOLE) for _ in range(2)]
    left = {p.relative_to(folder).parts for p in folder.rglob("*.parquet") if p not in before}
    assert len({x[0] for x in left}) == 2 and all(len(x) == 2 and x[0].startswith("kept-") for x in left)
    for df in (*got, *got):
        assert by_id(df, "text") == {0: ("one two three\nfour",)}


# ---------------------------------------------------------------- the pipeline


def test_pipeline(spark):
    """Each stage on its predecessor's rows, against brute force on the same rows."""
    import public_tokenizers

    import corpus_pipeline as c

    before = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in c.STAGES:
        after = common.stored(stage(spark, before, SF), "t")
        a, b = {r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in after.collect()}
        assert set(b) <= set(a)
        order = sorted(a)
        if name == "toxicity":
            m = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{SF}/labels.parquet"))
            assert set(b) == {i for i, (x,) in by_id(toxicity.score(before, m), "score").items() if x < 0.7}
        elif name == "line dedup":
            gone = brute_all_lines([a[i].text for i in order])
            for n, i in enumerate(order):
                left = [x for k, x in enumerate((a[i].text or "").split("\n")) if (n, k) not in gone]
                if "".join(left).strip() or not any(d == n for d, _ in gone):
                    assert b[i].text == "\n".join(left) and b[i].n_chars == len(b[i].text)
                else:
                    assert i not in b
        elif name.startswith("n-gram"):
            want = brute_jaccard([a[i].text for i in order], 5, 75)
            assert set(b) == {order[n] for n, (_, k) in want.items() if n == k}
        elif name.startswith("benchmark"):
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            for i in order:
                n, hit, _ = brute_hits(a[i].text, items, 10)
                assert (i in b) == (hit <= 0.5 * n) and (hit or b[i].text == a[i].text)
        else:
            p = pieces.pieces(public_tokenizers.path("piece_bpe_32k.model"))
            assert set(a) == set(b) and all(p.decode(b[i].ids) == (a[i].text or "") for i in a)
        if name != c.STAGES[-1][0]:
            assert after.columns == c.COLUMNS
        before = after


def test_pipeline_edges(spark):
    """Nulls in every column, empty and repeated rows, an empty table and further columns pass through every stage."""
    import corpus_pipeline as c

    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, _id string, gone int, score double"
    rows = [(1, None, None, None, None, "a", 1, 0.5), (2, "", "en", "s", 0, "a", 1, 0.5), (None, "a text of its own that nobody else has", "en", "s", 38, None, None, None), (3, "one two three four five six seven", "en", "s", 33, "a", 1, 0.5)]
    docs_ = spark.createDataFrame(rows + rows[3:], schema)
    for name, stage in c.STAGES:
        after = common.stored(stage(spark, docs_, SF), "t")
        kept = sorted((r.doc_id or 0) for r in after.collect())
        assert kept in ([0, 1, 2, 3, 3],), (name, kept)
        assert stage(spark, docs_.limit(0), SF).count() == 0
        assert name == c.STAGES[-1][0] or after.columns == c.COLUMNS
