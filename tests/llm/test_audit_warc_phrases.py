import glob
import gzip
import hashlib
import itertools
import os
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tessera.llm import collocations, filter_audit, warc
from tests.llm.cases import ROWS, documents, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# filter interactions ------------------------------------------------------------------------------


def audited(parts, filters):
    """parts: (part, failed letters, good, toxic) of each document; goes over all documents for all orders."""
    out, goes = {}, Counter()
    for part in {p for p, *_ in parts}:
        for order in itertools.permutations(filters):
            left = [d for d in parts if d[0] == part]
            for i, f in enumerate(order):
                gone = [d for d in left if f in d[1]]
                redundant = sum(f in d[1] for d in parts if d[0] == part) - len(gone)
                left = [d for d in left if f not in d[1]]
                goes[part, f] += len(gone)
                out[part, "".join(order), i + 1] = [len(left), len(gone), redundant, sum(d[1] == {f} for d in parts if d[0] == part), sum(d[2] for d in gone), sum(d[3] for d in gone)]
    return {k: (*v, goes[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def rows_of(df):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in df.collect()}


def failures(rows):
    for n, (i, text, *_) in enumerate(rows):
        t = text or ""
        words = WORD.findall(t)
        small = [j for j, u, *_ in rows if (u or "") == t and j is not None and (i is None or j < i)]
        tests = {"A": len(words) < 100, "B": 100 * len({*words}) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": re.search("[#$%&*|]", t), "E": small}
        yield {f for f, v in tests.items() if v}


def test_audit_awkward_rows(spark):
    many = " ".join(f"w{i}" for i in range(120))
    more = [(20, many, "en", "a"), (21, many, "de", "a"), (22, many + " #", "en", "a"), (23, "A B " * 80, "", "a"), (24, many + " W" * 60, "en", "a"), (20, many, "en", "a"), (None, many, "en", "a"), (None, many, None, "a")]
    rows = [*ROWS, *more]
    marks = [(20, 1, 0), (21, 1, 1), (21, 0, 0), (22, 1, 1), (23, None, 1), (None, 1, 1), (99, 1, 1), (4, 1, 0)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").withColumn("part", F.lit("clash")).withColumn("mask", F.lit(1))
    got = rows_of(filter_audit.audit_documents(documents(spark, rows).withColumn("mask", F.lit(3)).withColumn("part", F.lit("x")), labels))
    good, toxic = {i for i, q, _ in marks if q == 1 and i}, {i for i, _, t in marks if t == 1 and i}
    want = audited([(r[2] or "", f, r[0] in good, r[0] in toxic) for r, f in zip(rows, failures(rows), strict=True)], "ABCDE")
    assert got == want and len(got) == 600 * len({r[2] or "" for r in rows})
    assert filter_audit.audit_documents(empty(spark), labels).count() == 0
    assert rows_of(filter_audit.audit_documents(documents(spark, rows), labels.where("false")))[("en", "ABCDE", 1)][4:6] == (0, 0)


def test_audit_of_any_filters(spark):
    cells = [("x", m, bool(m & 1), not m & 2, 3 * m + 1) for m in range(8)] + [("y", 0, True, False, 5), ("y", 0, False, False, 2)]
    docs = [(p, {f for i, f in enumerate("pqr") if m >> i & 1}, g, t) for p, m, g, t, n in cells for _ in range(n)]
    df = spark.createDataFrame(cells, "part string, mask int, good boolean, toxic boolean, n bigint")
    assert rows_of(filter_audit.filter_audit(df, "pqr")) == audited(docs, "pqr")
    edges = filter_audit.lattice_edges(df, "pqr")
    assert edges.groupBy("part").count().collect()[0]["count"] == 3 * 4
    assert edges.where("part = 'x' AND subset = 0").agg(F.min("alive"), F.max("alive")).first()[:] == (92, 92)
    for bad in ("", "aa", "abcdefgh"):
        with pytest.raises(ValueError):
            filter_audit.filter_audit(df, bad)


def test_lattice_of_five_has_eighty_edges_and_six_hundred_steps(spark):
    paths = filter_audit.lattice_paths(spark, "ABCDE")
    assert paths.count() == 600 and paths.select("subset", "next").distinct().count() == 80


# archives -----------------------------------------------------------------------------------------

PAGES = [(i, f"http://a.example/{i}", f"<p>page {i % 7} " + "x" * (i % 50)) for i in range(300)] + [
    (300, None, None), (301, "", ""), (302, "http://b.example/a b\r\nX-Evil: 1", "<p>é漢😀\r\n\r\nWARC/1.1\r\n"), (303, "http://é.example/ü", None), (304, "u", "long " * 500),
    (7, "http://a.example/other", "<p>of a page with an id twice"), (5, "http://a.example/5", "<p>page 5 xxxxx"), (None, "n", "<p>no id"), (None, "n", "<p>no id"), (None, None, "<p>no id"), (None, "n", "<p>page 1 x"), (-4, "neg", "<p>page 2 xx"),
]


def archive(spark, tmp_path, name, rows=PAGES, **settings):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for c in ("id", "tie", "spread", "payload", "shard", "key", "size", "refers_to"):
        df = df.withColumn(c, F.lit(f"other {c}"))
    at = f"file://{tmp_path}/{name}"
    return warc.write_archives(df.repartition(3 + len(name)), at, **settings), at


def expected(rows, least=0):
    first = {}
    for i, _, t in rows:
        if i is not None and len((t or "").encode()) >= least:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, _, t in rows:
        data = (t or "").encode()
        ref = first.get(t or "") if len(data) >= least else None
        yield i, len(data), warc.base32_sha1(data), "response" if ref in (None, i) else "revisit", None if ref == i else ref


def of(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


@pytest.mark.parametrize("least", [0, 20])
def test_archives_round_trip(spark, tmp_path, least):
    manifest, at = archive(spark, tmp_path, "a", least_bytes=least, roll_bytes=3000, least_shards=8)
    back = warc.read_archives(spark, at).cache()
    assert of(back) == sorted(expected(PAGES, least), key=repr)
    by_record = {r.record_id: r for r in back.collect()}
    assert len(by_record) == len(PAGES)  # no identity twice
    texts = {(i, t or "") for i, _, t in PAGES}
    for r in by_record.values():
        if r.record_type == "response":
            assert (r.page_id, r.payload.decode()) in texts
        else:
            to = by_record[r.refers_to_record]
            assert to.record_type == "response" and to.page_id == r.refers_to and to.payload_digest == r.payload_digest
    assert {r.target_uri for r in by_record.values()} >= {"http://b.example/a%20b%0D%0AX-Evil:%201", "urn:x-page:300", "urn:x-page:301"}
    files = manifest.orderBy("file").collect()
    assert sum(f.records for f in files) == len(PAGES) and max(f.part for f in files) > 0 and len({f.shard for f in files}) > 3
    for f in files:
        data = open(f"{tmp_path}/a/{f.file}", "rb").read()
        assert len(data) == f.bytes and hashlib.sha1(data).hexdigest() == f.sha1
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: ")
    rolled = [f for f in files if any(g.shard == f.shard and g.part == f.part + 1 for g in files)]
    assert rolled and all(f.bytes >= 3000 for f in rolled)
    ids = [[int(x) for x in re.findall(rb"X-Page-Id: (-?\d+)", gzip.decompress(open(f"{tmp_path}/a/{f.file}", "rb").read()))] for f in files]
    assert sum(ids, []) == sorted(sum(ids, []))  # shards, files and records are in the order of the ids


def test_archives_come_out_the_same(spark, tmp_path):
    one, _ = archive(spark, tmp_path, "one", roll_bytes=3000, least_shards=8)
    two, _ = archive(spark, tmp_path, "second", PAGES[::-1], roll_bytes=3000, least_shards=8)
    assert sorted(one.collect()) == sorted(two.collect())
    assert sorted(os.path.basename(f) for f in glob.glob(f"{tmp_path}/one/*")) == sorted(os.path.basename(f) for f in glob.glob(f"{tmp_path}/second/*"))


def test_only_listed_files_are_read(spark, tmp_path):
    manifest, at = archive(spark, tmp_path, "a", PAGES[:30])
    stray = open(glob.glob(f"{tmp_path}/a/*.gz")[0], "rb").read()
    open(f"{tmp_path}/a/shard-00000099-0000.warc.gz", "wb").write(stray)  # of an attempt that did not count
    assert warc.read_archives(spark, at).count() == 30
    assert not glob.glob(f"{tmp_path}/a/_temporary*")
    with pytest.raises(ValueError, match="has an archive"):
        archive(spark, tmp_path, "a", PAGES[:3])


def test_damage_is_found(spark, tmp_path):
    whole = warc.record(1, "u", b"<p>text", None)
    assert next(warc.records(iter([warc.member(whole)])))[1].endswith(b"<p>text")
    for bad in (whole.replace(b"<p>text", b"<p>tExt"), whole[:-3], whole.replace(b"WARC/1.1", b"WARC/0.9")):
        with pytest.raises(ValueError):
            list(warc.records(iter([warc.member(bad)])))
    data = warc.member(whole) + warc.member(warc.record(2, None, b"", 1))
    assert [h["WARC-Type"] for h, _ in warc.records(data[i : i + 1] for i in range(len(data)))] == ["response", "revisit"]
    with pytest.raises(ValueError):
        list(warc.records(iter([data[:-9]])))


def test_archive_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.write_archives(df, f"file://{tmp_path}/none").count() == 0
    assert warc.read_archives(spark, f"file://{tmp_path}/none").count() == 0


def test_shards_have_about_as_many_bytes(spark):
    keys = spark.range(20_000).select("id", F.lit(0).cast("long").alias("spread"), F.lit(1).cast("long").alias("tie"), F.when(F.col("id") < 1000, 100_000).otherwise(100).cast("long").alias("size"))
    bounds = [x for x, _ in warc.shard_bounds(keys, 10_000_000, 4, 3000)]
    assert bounds == sorted({*bounds}) and bounds == [x for x, _ in warc.shard_bounds(keys.orderBy(F.rand()), 10_000_000, 4, 3000)]
    sizes = [sum(100_000 if i < 1000 else 100 for i in range(a, b)) for a, b in itertools.pairwise([0, *bounds, 20_000])]
    assert 9 <= len(sizes) <= 11 and max(sizes) < 20_000_000


# collocations -------------------------------------------------------------------------------------


def phrases(rows, longest=3, least=10, most=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            inside = any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items())
            score, k = min((int(Fraction(10**6 * a * a, c[p[:k]] * c[p[k:]])), k) for k in range(1, len(p)))
            if not inside:
                rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:most], 1):
            yield lang, rank, p.decode(), -a, l, r, n[lang], -s


def test_phrases_awkward_rows(spark, monkeypatch):
    texts = ["Big red\tdog, big red dog! the\x0bend of THE\x0cend", "a a a a a a a a a a a a a", "x y z. x y. y z; x  y\t\tz: É é É é", "new york city " * 4, "", None, " \t\n .,;", "ab\x00cd ef " * 6, "in the house in the house"]
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate(itertools.product(texts * 4, ["en", None, "und", "zh"]))] + [(None, "big red " * 30_000, "en", None), (1, "漢字 😀 " * 25, "zh", "s")]
    want = sorted(phrases([(t, l) for _, t, l, _ in rows]))
    df = documents(spark, rows).withColumn("piece", F.lit("x")).withColumn("m", F.lit(2)).withColumn("phrase", F.lit("p")).withColumn("a", F.lit(1))
    assert sorted(tuple(r) for r in collocations.collocations(df).collect()) == want and len(want) > 20
    assert sorted(tuple(r) for r in collocations.collocations(df, longest=4, least=3, most=5).collect()) == sorted(phrases([(t, l) for _, t, l, _ in rows], 4, 3, 5))
    monkeypatch.setattr(collocations, "CHUNK", 300)
    monkeypatch.setattr(collocations, "DEAL", 3)
    assert sorted(tuple(r) for r in collocations.collocations(df).collect()) == want
    assert collocations.collocations(empty(spark)).count() == 0


def test_scores_are_exact_and_go_to_the_first_cut(spark):
    big = 10**14 + 7
    rows = [("en", "a b", big, ), ("en", "a", big + 1), ("en", "b", 3 * big + 11), ("en", "x y z", 50), ("en", "x", 100), ("en", "y z", 100), ("en", "x y", 100), ("en", "z", 100), ("en", "y", 100), ("en", "q r", 9), ("en", "q", 9), ("en", "r", 9)]
    got = {r.phrase: r for r in collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, n bigint"), 3, 10).collect()}
    assert got["a b"].score == 10**6 * big * big // ((big + 1) * (3 * big + 11))
    assert (got["x y z"].k, got["x y z"].score) == (1, 250_000) and "q r" not in got


def test_equal_pieces_are_counted_once(spark):
    got = {(r.piece, r.words, r.m) for r in collocations.pieces(spark.createDataFrame([("A  b. a\tb! c", "en"), ("a b", "en")], "text string, lang string")).collect()}
    assert got == {("a b", 2, 3), ("c", 1, 1)}


def test_phrases_of_a_chunk_are_summed_by_numbers_of_their_words():
    import numpy as np
    import pyarrow as pa

    r = random.Random(4)
    rows = [(r.choice(["en", "de", "漢"]), " ".join(r.choice(["a", "b", "É", "漢字", "zz"]) for _ in range(r.choice([r.randint(1, 9), 60]))), r.randint(1, 10**12)) for _ in range(400)]
    grams = collocations.Grams(pa.table({"lang": [x for x, _, _ in rows], "piece": [x for _, x, _ in rows]}))
    m = np.array([x for _, _, x in rows])
    for k in (1, 2, 3, 40):  # numbers of 40 words pass 64 bits
        want = Counter()
        for lang, piece, n in rows:
            w = piece.split(" ")
            for i in range(len(w) - k + 1):
                want[lang, " ".join(w[i : i + k])] += n
        at, sums = grams.summed(grams.at(k), k, m)
        got = list(zip(grams.langs.take(pa.array(grams.lang[at])).to_pylist(), grams.phrases(at, k).to_pylist(), sums.tolist(), strict=True))
        assert len(got) == len(want) and {(a, b): n for a, b, n in got} == want


def test_database_goes_on_in_the_shared_folder(tmp_path):
    with collocations._database(str(tmp_path)) as con:
        con.execute("CREATE TABLE t AS SELECT range AS i, md5(range::VARCHAR) || md5((range + 1)::VARCHAR) AS s FROM range(6000000)")
        assert con.sql("SELECT count(*) FROM (SELECT s, sum(i) FROM t GROUP BY s)").fetchall() == [(6_000_000,)]
        assert os.listdir(tmp_path)
    assert not os.listdir(tmp_path)


@pytest.mark.parametrize("bits", [64, 1 << 12])
def test_the_filter_misses_no_frequent_phrase(spark, bits):
    import random

    r = random.Random(8)
    texts = [(" ".join(r.choice("abcdefgh") * r.choice([1, 1, 1, 2, r.randint(1, 40)]) for _ in range(30)), "en") for _ in range(60)]
    found = collocations.pieces(spark.createDataFrame(texts, "text string, lang string"))
    got = {(r.phrase): r.n for r in collocations.counted(found, 4, 5, bits=bits, bucket_rows=500).collect()}
    want = Counter()
    for t, _ in texts:
        w = t.split()
        want.update(" ".join(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    assert got == {p: n for p, n in want.items() if n >= 5} and len(got) > 100
