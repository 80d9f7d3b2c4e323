import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, fingerprints, html_text, line_dedup, lm_score, mixing, ngram_join, pieces, quality, registry, secrets
from tessera.llm.common import written
from tests.conftest import SF
from tests.llm.cases import LONG, ROWS, documents, empty

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def small():
    return duckdb.sql(f"SELECT doc_id, coalesce(text, ''), source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def rows(df, *by):
    return df.orderBy(*by).collect()


# against SQL ------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_against_sql(name, same):
    same(name)


def test_every_operator_has_a_query():
    assert {int(k[2:].split("_")[0]) for k in registry.QUERIES if k.startswith("op")} == set(range(1, 14))


# 1 ------------------------------------------------------------------------------------------------

def shingles(text, n=5):
    w = text.encode().split()
    n = min(n, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def linked(docs):
    """{id: (class, size, links, linked documents, group)} by comparing every two classes."""
    classes = collections.defaultdict(list)
    for k, t in docs:
        classes[shingles(t)].append(k)
    sets = list(classes)
    links = {i: {j for j, b in enumerate(sets) if i != j and len(a & b) >= 0.8 * len(a | b) and a and b} for i, a in enumerate(sets)}
    group = {}
    for i in range(len(sets)):
        if i not in group:
            todo, seen = [i], {i}
            while todo:
                for j in links[todo.pop()] - seen:
                    seen.add(j), todo.append(j)
            head = min(min(classes[sets[j]]) for j in seen)
            group |= dict.fromkeys(seen, head)
    return {k: (min(classes[s]), len(classes[s]), len(links[i]), sum(len(classes[sets[j]]) for j in links[i]), group[i]) for i, s in enumerate(sets) for k in classes[s]}


def near_copies(seed, families=12, copies=9, words=120):
    random.seed(seed)
    docs, k = [], 0
    for _ in range(families):
        base = [f"v{random.randint(0, 5000)}" for _ in range(words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(random.randint(0, 6)):
                text[random.randrange(words)] = f"z{random.randint(0, 10**6)}"
            docs.append((k, " ".join(text)))
            k += 1
    return docs


@pytest.mark.parametrize("block", [256, 4])
def test_join_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)  # small blocks deal each family over many
    docs = near_copies(1)
    got = ngram_join.similar_classes(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == linked(docs)


def test_join_awkward_rows(spark):
    got = rows(ngram_join.similar_classes(documents(spark)), "doc_id")
    assert len(got) == len(ROWS)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[4].class_id == by[5].class_id == 4 and by[4].class_size == 3
    assert by[6].n_links == 1 and by[7].group_id == 6 and by[1].class_id == 1 and by[1].n_links == 0
    assert ngram_join.similar_classes(empty(spark)).count() == 0


def test_join_verifies_what_survives_only(spark, monkeypatch):
    import numpy as np

    random.seed(9)
    words = [f"c{i}" for i in range(1200)]  # each document is like the next few only: links grow as the chain, pairs as its square
    chain = [(k, " ".join(words[4 * k : 4 * k + 150])) for k in range(200)]
    want = linked(chain)
    got = ngram_join.similar_classes(spark.createDataFrame(chain, "doc_id bigint, text string")).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == want
    assert {g for *_, g in want.values()} == {0} and max(n for _, _, n, *_ in want.values()) < 10
    for same, alive in ((True, np.triu(np.random.default_rng(1).random((60, 60)) < 0.02, 1)), (False, np.random.default_rng(2).random((40, 70)) < 0.5), (True, np.zeros((5, 5), bool))):
        found, named = set(), 0
        for rows_, columns, part in ngram_join.parts_of(alive, same):
            named += len(rows_) + len(columns)
            new = {(rows_[i], columns[j]) for i, j in zip(*np.nonzero(part), strict=True)}
            assert not new & found
            found |= new
        assert found == set(zip(*np.nonzero(alive), strict=True)) and named <= 2 * len(found)
    a, b = ([np.unique(np.random.default_rng(k).integers(0, 50, 40).astype(np.uint64)) for k in range(at, at + 6)] for at in (0, 3))
    every = np.array([[len(np.intersect1d(x, y)) / len(np.union1d(x, y)) for y in b] for x in a])
    for i, j in (np.nonzero(np.ones((6, 6))), np.array([[1, 5], [2, 0]])):
        assert np.allclose(ngram_join.similarities(a, b, i, j), every[i, j])


def test_least_matches_prune_what_is_unlikely():
    for n, m in zip(range(16, 129, 16), ngram_join.least_matches(0.8, 1e-4), strict=True):
        tail = lambda m, n=n: sum(math.comb(n + 1, k) * 0.8**k * 0.2 ** (n + 1 - k) for k in range(m + 1))
        assert tail(m) >= 1e-4 > tail(m - 1)


def test_all_steps_together_miss_less_than_the_tolerance():
    import numpy as np

    least = ngram_join.pruning(0.8, 1e-4)
    left = np.eye(1, 129)[0]
    for m in least:  # one value at a time, cut after each step
        for _ in range(16):
            left = 0.2 * left + 0.8 * np.roll(left, 1)
        left[:m] = 0
    assert 0 < 1 - left.sum() < 1e-4
    assert all(a <= b for a, b in zip(least, ngram_join.least_matches(0.8, 1e-4), strict=True))


def test_keep_one(spark):
    kept = ngram_join.keep_one(documents(spark))
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == [-3, 1, 4, 4, 6, 8, 9, 10, 10**15]
    assert kept.columns == documents(spark).columns


# 2 ------------------------------------------------------------------------------------------------

def test_quality_on_held_out_labels(spark):
    d = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = quality.quality_scores(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
    right = got.kept == (got.quality == 1)
    assert right.mean() > 0.97 and (got.kept | (got.quality == 0)).mean() > 0.99


def test_quality_awkward_rows(spark):
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 0), (None, 1, 0), (8, None, 0), (99, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = quality.quality_scores(documents(spark), labels)
    assert got.count() == len(ROWS) and got.where("score IS NULL OR isnan(score)").count() == 0
    assert quality.quality_scores(empty(spark), labels).count() == 0
    none = quality.quality_scores(documents(spark), labels.where("false"))
    assert none.where("abs(score - 0.5) > 1e-9 OR NOT kept").count() == 0
    assert quality.keep_quality(documents(spark), labels).columns == documents(spark).columns


def test_sparse_sites_shrink_and_others_do_not(spark):
    random.seed(6)
    good, bad = "Plain words that follow one another here.", "AA!! BB!! CC!! DD!! EE!! FF!! ###"
    docs = [(i, good if i % 2 else bad, "en", "mixed") for i in range(200)] + [(1000 + i, bad, "en", "bad") for i in range(100)] + [(2000, bad, "en", "one")]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id bigint, quality int, toxic int")
    got = {(r.host, r.doc_id): r for r in quality.quality_scores(documents(spark, docs), labels).collect()}
    mean = sum(r.doc_score for r in got.values()) / len(got)
    assert got["bad", 1000].host_posterior < 0.05 and abs(got["one", 2000].host_posterior - mean) < 0.02


def test_posteriors_by_hand(spark, small):
    """Everything after the documents' own log odds, in plain Python."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    facts, model, _, _ = quality.fit(docs, labels, F.col("source"), F.col("lang"))
    odds = {r.id: r for r in facts.collect()}
    got = {r.doc_id: r for r in quality.quality_scores(docs, labels).collect()}
    clip = lambda p: min(1 - 1e-6, max(1e-6, p))
    logit = lambda p: math.log(clip(p) / (1 - clip(p)))
    p = {k: 1 / (1 + math.exp(-r.log_odds)) for k, r in odds.items()}
    mean = sum(p.values()) / len(p)

    def strength(groups):  # [(n, s, prior mean)]
        spread = sum(n * (s / n - m) ** 2 for n, s, m in groups)
        noise = sum(m * (1 - m) for *_, m in groups)
        size = sum(n for n, *_ in groups) - sum(n * n for n, *_ in groups) / sum(n for n, *_ in groups)
        between = (spread - noise) / size if size else 0
        return min(1e6, max(2, sum(m * (1 - m) for *_, m in groups) / len(groups) / between - 1)) if between > 0 else 1e6

    hosts, paths = collections.defaultdict(list), collections.defaultdict(list)
    for k, r in odds.items():
        hosts[r.host].append(p[k]), paths[r.host, r.path].append(p[k])
    hk = strength([(len(v), sum(v), mean) for v in hosts.values()])
    own = {h: (hk * mean + sum(v)) / (hk + len(v)) for h, v in hosts.items()}
    pk = strength([(len(v), sum(v), own[h]) for (h, _), v in paths.items()])
    for k, r in odds.items():
        host = (hk * mean + sum(hosts[r.host]) - p[k]) / (hk + len(hosts[r.host]) - 1)
        path = (pk * host + sum(paths[r.host, r.path]) - p[k]) / (pk + len(paths[r.host, r.path]) - 1)
        score = 1 / (1 + math.exp(-(r.log_odds + logit(path) - logit(mean))))
        assert abs(got[k].host_posterior - host) < 1e-6 and abs(got[k].path_posterior - path) < 1e-6 and abs(got[k].score - score) < 1e-6
        assert got[k].kept == (got[k].score >= 0.5)


def test_words_are_evidence(spark):
    random.seed(11)
    good, bad = [f"g{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    text = lambda own: " ".join(random.choice(own) if random.random() < 0.5 else f"n{random.randint(0, 99)}" for _ in range(30))
    docs = [(i, text(good if i % 2 else bad), "en", "s") for i in range(600)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(400)], "doc_id bigint, quality int, toxic int")
    got = quality.quality_scores(documents(spark, docs), labels).where("doc_id >= 400").collect()
    assert sum(r.kept == (r.doc_id % 2 == 1) for r in got) > 190
    assert quality.lexical_weights([], __import__("numpy").zeros(0)).any() == False  # noqa: E712


# 3 ------------------------------------------------------------------------------------------------

def test_exact_dedup_awkward_rows(spark):
    got = exact_dedup.exact_dedup(documents(spark), digest=True).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = collections.defaultdict(list)
    for i, t, *_ in ROWS:
        groups[norm(t)].append((-len(t or ""), i is None, i or 0, i))
    want = collections.Counter()
    for n, members in groups.items():
        keep = min(members)[3]
        want.update((i, keep, len(members), i == keep, hashlib.sha256(n.encode()).hexdigest()) for *_, i in members)
    assert collections.Counter(tuple(r) for r in got) == want
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


# 4 ------------------------------------------------------------------------------------------------

def test_lm_against_counts(spark, small, monkeypatch):
    monkeypatch.setattr(lm_score, "SHARD", 3000)  # many shards
    got = {r.doc_id: r for r in lm_score.lm_scores(spark.createDataFrame([x[:2] for x in small], "doc_id bigint, text string").repartition(3)).collect()}
    tokens = {k: t.encode().lower().split() + [None] for k, t, _ in small}
    held = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k in tokens}
    one, two, starts = collections.Counter(), collections.Counter(), 0
    for k, x in tokens.items():
        if not held[k]:
            one.update(x), two.update(zip(["<s>", *x[:-1]], x, strict=True))
            starts += 1
    n, v = sum(one.values()), len(one)
    for k, x in tokens.items():
        r = got[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[k], len(x), sum(one[w] > 0 for w in x), n)
        assert abs(r.base_score - sum(math.log10((one[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x)) < 1e-6
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_lm_score_by_definition(spark, small, monkeypatch):
    """Deleted interpolation in plain Python, its weights from unbinned ratios."""
    monkeypatch.setattr(lm_score, "SHARD", 3000)
    got = {r.doc_id: r for r in lm_score.lm_scores(spark.createDataFrame([x[:2] for x in small], "doc_id bigint, text string").repartition(3)).collect()}
    tokens = {k: t.encode().lower().split() + [None] for k, t, _ in small}
    train = [x for k, x in tokens.items() if zlib.crc32(str(k).encode()) % 5 != 1]
    one, two = collections.Counter(w for x in train for w in x), collections.Counter(p for x in train for p in zip(["<s>", *x[:-1]], x, strict=True))
    n, v, texts = sum(one.values()), len(one), len(train)
    count = lambda c: texts if c == "<s>" else one[c]
    held = collections.defaultdict(collections.Counter)  # by bucket: (bigram ratio, word ratio), the token taken out
    for x in train:
        for c, w in zip(["<s>", *x[:-1]], x, strict=True):
            left = count(c) - 1
            held[left.bit_length()][(two[c, w] - 1) / max(1, left), (one[w] - 1) / (n - 1)] += 1
    weights = {}
    for b, cells in held.items():
        a = [1 / 3] * 3
        for _ in range(100):
            new = [0.0] * 3
            for (p2, p1), k in cells.items():
                parts = [a[0] * p2, a[1] * p1, a[2] / (v + 1)]
                for i in range(3):
                    new[i] += k * parts[i] / sum(parts)
            a = [x / sum(cells.values()) for x in new]
        weights[b] = [max(x, 1e-6) for x in a]
    worst, total = 0.0, 0
    for k, x in tokens.items():
        want = 0.0
        for c, w in zip(["<s>", *x[:-1]], x, strict=True):
            a = weights[count(c).bit_length()] if count(c).bit_length() in weights else weights[max(b for b in weights if b <= count(c).bit_length())]
            p = a[0] * two[c, w] / max(1, count(c)) + a[1] * one[w] / n + a[2] / (v + 1) + (a[0] * one[w] / n if not count(c) else 0)
            want += math.log10(p)
        total += len(x)
        worst = max(worst, abs(got[k].score - want) / len(x))
    assert worst < 0.02  # a token, from the steps of the ratios


def test_lm_awkward_rows(spark):
    got = lm_score.lm_scores(documents(spark)).collect()
    assert len(got) == len(ROWS) and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert lm_score.lm_scores(empty(spark)).count() == 0


def test_weights_are_learned():
    import numpy as np

    cell = lambda b, two, one: (b * (lm_score.LEVELS + 1) + two) * (lm_score.LEVELS + 1) + one
    w = lm_score.interpolation_weights(np.array([cell(3, 60, 20), cell(7, 0, 50)]), np.array([1000.0, 1000.0]))
    assert w[3][0] > 0.9 and w[7][1] > 0.9 and abs(sum(w[3]) - 1) < 1e-9


# 5 ------------------------------------------------------------------------------------------------

def test_mix_awkward_rows(spark):
    got = mixing.mix(documents(spark), block=4)
    out = got.collect()
    assert len(out) == len(ROWS) and all(0 <= r.taken <= 2 * r.size for r in out)
    for (target,), group in collections.Counter((r.target,) for r in out).items():
        assert group
        assert abs(sum(r.taken for r in out if r.target == target) - target * len({r.source_size for r in out if r.target == target})) <= 1
    assert mixing.mix(empty(spark)).count() == 0
    mixed = mixing.mixed_documents(documents(spark), block=4)
    assert mixed.columns == documents(spark).columns
    assert mixed.select(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(r.taken for r in out)


def test_mix_is_the_schedule(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 50 + 1), "en", "abc"[i % 3]) for i in range(300)], "doc_id bigint, text string, lang string, source string")
    sources, spans, slots = mixing.mix_plan(docs, block=16)
    s = slots.orderBy("slot").collect()
    target = {r.pos: r.quota for r in sources.collect()}
    half = collections.Counter()
    for r in s[: len(s) // 2]:
        half[r.pos] += r.words
    for pos, quota in target.items():  # any first part of the mix has the right shares
        assert abs(half[pos] - quota / 2) <= 16 * 6
    assert {p: sum(r.words for r in s if r.pos == p) for p in target} == target


def test_mix_depends_on_the_sequence(spark, monkeypatch):
    docs = documents(spark, [(i, "w " * (i % 50 + 1), "en", "abc"[i % 3]) for i in range(300)])
    facts = lambda: {r.doc_id: r for r in mixing.mix(docs, block=16).collect()}
    before, first = facts(), [r.doc_id for r in mixing.mixed_documents(docs, block=16).collect()]
    monkeypatch.setattr(mixing, "GOLDEN", 1)
    after, second = facts(), [r.doc_id for r in mixing.mixed_documents(docs, block=16).collect()]
    assert sum(before[k].first_slot != after[k].first_slot for k in before if before[k].taken) > 100 and first != second
    assert {k: r.taken for k, r in before.items()} == {k: r.taken for k, r in after.items()} and sorted(first) == sorted(second)


def test_mixed_documents_come_in_slot_order(spark):
    docs = documents(spark, [(i, f"t{i} " * (i % 50 + 1), "en", "abc"[i % 3]) for i in range(300)])
    start = {r.doc_id: r.first_slot for r in mixing.mix(docs, block=16).collect()}
    got = [r.doc_id for r in mixing.mixed_documents(docs, block=16).collect()]
    firsts = [start[k] for k in dict.fromkeys(got)]
    assert firsts == sorted(firsts) and len(got) > len(set(got))


def test_mix_ties(spark):
    cases = [(7, "a a a a", "en", "A"), (7, "b b b b", "en", "B"), (7, "c c c c", "en", "A"), (None, "d d d d", "en", "A"), (None, "e e e e", "en", "B"), (1, "f f f f", "en", "B"), (1, "f f f f", "en", "B")]
    seen = set()
    for parts in (1, 2, 3):
        docs = documents(spark, cases).repartition(parts, F.xxhash64("text"))
        taken = collections.Counter(tuple(r) for r in mixing.mix(docs, block=2).collect())
        mixed = collections.Counter(tuple(r) for r in mixing.mixed_documents(docs, block=2).select("doc_id", "text", "source").collect())
        words = collections.Counter()
        for (_, t, s), k in mixed.items():
            words[s] += k * len(t.split())
        want = collections.Counter()
        for r, k in taken.items():
            want[{12: "A", 16: "B"}[r[2]]] += k * r[4]
        assert words == want  # each source gives its own words
        seen.add((frozenset(taken.items()), frozenset(mixed.items())))
    assert len(seen) == 1


# 6 ------------------------------------------------------------------------------------------------

def test_pages_against_their_article(spark):
    import html

    def article(page):
        inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = (re.sub(r"[\x20\x09-\x0D]+", " ", html.unescape(re.sub(r"<[^>]+>", " ", x))).strip(" ") for x in re.split(r"</?(?:p|h1)>", inner))
        return "\n\n".join(b for b in blocks if b)

    got = html_text.op6_html_extraction(spark, SF).collect()
    want = {k: article(h) for k, h in duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()}
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)


def test_pages_without_article_tags():
    page = """<html><body class="has-sidebar"><header><h1>Site</h1></header><div id="cookie-notice">We use cookies, really.</div>
    <div id="content"><div class="post"><h2>Title</h2><p>First paragraph, long enough, with commas.<p>Second one &amp; more; good enough, too.</div>
    <div class="comments"><p>Great article, thanks!</p></div></div><aside>side</aside><form><p>Sign up, now.</p></form><footer>foot</footer></body></html>"""
    assert html_text.main_blocks(page) == ["Title", "First paragraph, long enough, with commas.", "Second one & more; good enough, too."]


def test_pages_with_several_roots():
    page = "<body><main><header><h1>Title</h1></header><p>Lead, in short.</p><article><p>The body, which is long enough, with commas.</p></article><nav>menu</nav><p>An end, too.</p></main><p>out</p></body>"
    assert html_text.main_blocks(page) == ["Title", "Lead, in short.", "The body, which is long enough, with commas.", "An end, too."]
    posts = [f"Post {k} has its own words, some commas, and an end." for k in range(3)]
    page = "<body>" + "".join(f'<article class="post-{k}"><h2>Head {k}</h2><p>{p}</p></article>' for k, p in enumerate(posts)) + "<p>x</p></body>"
    assert html_text.main_blocks(page) == [x for k, p in enumerate(posts) for x in (f"Head {k}", p)]


def test_pages_are_not_emptied_by_attributes():
    text = "Some text of a page, long enough, with commas."
    for tag in ('article data-title="The hidden valley"', 'p title="Hidden costs"', 'p data-hidden="false"', 'article data-id="comment-12"', "p data-x='class=comments'", 'div class="content with-sidebar"', 'div id="page" class="no-banner"'):
        assert html_text.main_blocks(f"<body><nav>menu</nav><{tag}>{text}</{tag.split()[0]}></body>") == [text], tag
    for tag in ("p hidden", 'p aria-hidden="true"', 'div style="display: none"', "div class=comments", 'div HIDDEN=""'):
        assert html_text.main_blocks(f"<body><p>{text}</p><{tag}>Not this, no.</{tag.split()[0]}></body>") == [text], tag
    comments = '<div class="comments">' + "<p>Nice, thanks, and so on.</p>" * 9 + "</div>"
    for page in (f"<div class=post><p>{text}</p></div>{comments}", f'<div class="content with-sidebar"><p>{text}</p>{comments}</div><div class=sidebar>beside</div>'):
        assert html_text.main_blocks(f"<body>{page}</body>") == [text]


def test_ratios_decide(monkeypatch):
    pages = [h for (h,) in duckdb.sql(f"SELECT html FROM '{SF}/pages.parquet'").fetchall()]
    got = [html_text.main_blocks(h) for h in pages]
    bare = [re.sub(r'\s(class|id|role)="[^"]*"', "", re.sub(r"<(/?)(article|main)\b", r"<\1div", h)) for h in pages]
    assert sum(html_text.main_blocks(h) == g for h, g in zip(bare, got, strict=True)) >= 0.9 * len(pages)  # names are not needed
    monkeypatch.setattr(html_text, "path_scores", lambda blocks: [1.0] * len(blocks))
    assert sum(html_text.main_blocks(h) != g for h, g in zip(pages, got, strict=True)) > 0.5 * len(pages)


def test_path_scores_by_definition():
    page = "<body><nav><a>menu, menu</a></nav><div><h1>Title!</h1><p>One, two.</p><p>Three, four, five; six. <a>x</a></p></div><aside><p>Beside, it.</p></aside></body>"
    blocks = html_text.blocks_of(page)
    marks = lambda t: len(re.findall(r"[.,;:!?]", t))
    paths = collections.defaultdict(list)
    for b in blocks:
        paths[b.path].append(b)
    own = {p: sum(len(b.text) for b in bs) / len(bs) * (1 + sum(marks(b.text) for b in bs) / len(bs)) * (1 - sum(b.linked for b in bs) / sum(len(b.text) for b in bs)) for p, bs in paths.items()}
    ratio = [own[b.path] * (html_text.BESIDE if b.outside else 1) for b in blocks]
    near = lambda i: [(math.exp(-((i - j) ** 2) / 2), ratio[j]) for j in range(len(blocks)) if abs(i - j) <= 1]
    smooth = [sum(k * r for k, r in near(i)) / sum(k for k, _ in near(i)) for i in range(len(blocks))]
    mean = {p: sum(smooth[i] for i, b in enumerate(blocks) if b.path == p) / len(bs) for p, bs in paths.items()}
    want = [math.sqrt(own[b.path] * mean[b.path]) * (html_text.BESIDE if b.outside else 1) for b in blocks]
    assert [b.outside for b in blocks] == [True, False, False, False, True]
    assert all(abs(a - b) < 1e-9 for a, b in zip(html_text.path_scores(blocks), want, strict=True)) and want[0] == 0 < want[1]


def test_pages_awkward(spark):
    pages = [(1, "u", None), (2, None, ""), (3, "u", "<p>a < b"), (4, "u", "<!-- open"), (5, "u", "<script>x</script>"), (None, "u", "<p>x&nbsp;y</p>"), (6, "u", "<div>" * 3000 + "deep text, here." + "</div>" * 3000), (6, "u", "<article><p>a</p></article>")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("text", F.lit("other")).withColumn("n_chars", F.lit(1))
    got = html_text.extract_pages(df).collect()
    assert len(got) == len(pages) and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text for r in got if r.page_id in (1, 2, 4, 5)} == {1: "", 2: "", 4: "", 5: ""}
    assert html_text.extract_pages(df.where("false")).count() == 0


# 7 ------------------------------------------------------------------------------------------------

def test_pieces_against_the_library(spark, small):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    with open(pieces.default_model(), "rb") as f:
        mine = pieces.Pieces(f.read())
    random.seed(1)
    texts = [t for _, t, _ in small] + [t or "" for _, t, *_ in ROWS] + [" " * n + "a" + " " * n for n in range(40)]
    texts += ["".join(random.choice("abcdefghij kl\n\té我梦😀▁ABC01\0.,<>") for _ in range(random.randint(0, 40))) for _ in range(2000)]
    for t in texts:
        ids = lib.encode(t, add_eos=True)
        n, joined, back = mine.digest(t)
        assert (n, joined, back) == (len(ids), " ".join(map(str, ids)), lib.decode(ids))
    for t in texts[:40]:
        assert mine.encode(t) == lib.encode(t, add_eos=True) and mine.decode(mine.encode(t)) == lib.decode(lib.encode(t))


def test_pieces_decode_their_ids():
    with open(pieces.default_model(), "rb") as f:
        mine = pieces.Pieces(f.read())
    assert mine.digest("a text of words")[2] == "a text of words"
    mine.chunks.clear()
    mine.id = {p: i - 1 for p, i in mine.id.items()}  # wrong ids must show in the text
    _, ids, back = mine.digest("a text of words")
    assert back != "a text of words" and back == mine.decode(list(map(int, ids.split())))


def test_an_idle_worker_gives_up_the_encoders_memos(monkeypatch):
    import time

    monkeypatch.setattr(pieces, "IDLE", 0.2)
    with open(pieces.default_model(), "rb") as f:
        mine = pieces.Pieces(f.read())
    want = mine.digest("a text of words\nand 漢字")
    assert all(isinstance(v, str) for v in mine.chunks.values())  # what decodes to itself is held once
    mine.rest()
    mine.busy()  # the next task comes at once
    time.sleep(0.5)
    assert mine.chunks and mine.pairs
    mine.rest()
    time.sleep(1)
    assert not mine.chunks and not mine.pairs and mine.digest("a text of words\nand 漢字") == want


def test_pieces_awkward_rows(spark):
    got = pieces.encode_pieces(documents(spark)).collect()
    assert len(got) == len(ROWS) and [r.token_ids for r in got if r.doc_id == 1] == [[2]]
    assert {r.decoded for r in got if r.doc_id == 8} == {ROWS[10][1]} and pieces.encode_pieces(empty(spark)).count() == 0


# 8 ------------------------------------------------------------------------------------------------

def jaccard(a, b):
    x, y = collections.Counter(WORDS.findall(a)), collections.Counter(WORDS.findall(b))
    return sum((x & y).values()) / max(1, sum((x | y).values())) if x or y else 1.0


def test_fingerprints_against_jaccard(spark, small):
    got = {r.doc_id: r for r in fingerprints.fingerprints(spark.createDataFrame([x[:2] for x in small], "doc_id bigint, text string"), samples=128).collect()}
    errors, seen = [], {}
    for i, (k, t, _) in enumerate(small):
        after = small[(i + 1) % len(small)][1]
        q = len(t) // 4
        edited = t[: len(t) - q] + after[:q]
        assert got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[k].n_chars == len(t)
        assert seen.setdefault(t, got[k].fingerprint) == got[k].fingerprint
        errors += [got[k].near_edited - jaccard(t, edited), got[k].near_next - jaccard(t, after)]
    assert abs(sum(errors) / len(errors)) < 0.01 and max(map(abs, errors)) < 5 * 0.5 / 128**0.5


def test_fingerprints_awkward_rows(spark):
    got = fingerprints.fingerprints(documents(spark)).collect()
    assert len(got) == len(ROWS)
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == by[2].fingerprint == by[3].fingerprint == "" and by[1].near_next == 1.0
    assert by[4].near_next == 1.0  # its own copy, then 5 with the same words
    assert fingerprints.fingerprints(empty(spark)).count() == 0
    alone = fingerprints.fingerprints(documents(spark, [(5, "a b c d", "en", "x")])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0 and alone[0].edited_sha256 == hashlib.sha256(b"a b c a").hexdigest()


def test_fingerprints_of_one_long_word_and_of_any_ids(spark):
    import time

    began = time.time()
    got = fingerprints.fingerprints(spark.createDataFrame([(1, "x" * 1_000_000), (2, "y z " + "w" * 1_000_000)], "doc_id bigint, text string")).collect()
    assert len(got) == 2 and time.time() - began < 60
    random.seed(8)
    texts = [" ".join(f"v{random.randint(0, 30)}" for _ in range(40)) for _ in range(1500)]
    for ids in (range(1500), [random.randint(-(2**62), 2**62) for _ in range(1500)], [k * k * k * k for k in range(1500)], [k % 5 for k in range(1500)], [None if k % 3 else k for k in range(1500)]):
        docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id bigint, text string").repartition(3)
        out = fingerprints.fingerprints(docs, samples=8)
        signs = {r.t: r.s for r in docs.select(F.col("text").alias("t"), F.xxhash64("text").alias("s")).collect()}
        order = sorted(zip(ids, texts, strict=True), key=lambda x: (x[0] is None, x[0] or 0, signs[x[1]], x[1]))
        want = collections.Counter()
        for (i, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
            q = len(t) // 4
            want[i, hashlib.sha256((t[: len(t) - q] + after[:q]).encode()).hexdigest()] += 1
        assert collections.Counter((r.doc_id, r.edited_sha256) for r in out.select("doc_id", "edited_sha256").collect()) == want


def test_gamma_numbers(spark):
    import numpy as np

    rows_ = spark.range(40_000).select(F.col("id").alias("bucket"), F.xxhash64("id").alias("term"), F.lit(0.0).alias("x"))
    least = fingerprints._samples(rows_, ["bucket"]).select("s0", "s1").toPandas()
    a = np.sort(least.to_numpy().ravel() / 2.0**59)  # c exp(-r (1 - b)), alone in its group
    rng = np.random.default_rng(5)
    other = np.sort(rng.gamma(2, 1, 400_000) * np.exp(-rng.gamma(2, 1, 400_000) * (1 - rng.random(400_000))))
    for q in (0.01, 0.1, 0.5, 0.9, 0.99):
        assert abs(np.quantile(a, q) / np.quantile(other, q) - 1) < 0.06


# 9 ------------------------------------------------------------------------------------------------

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32])


def test_secrets_against_plain_expressions(small):
    random.seed(3)
    bits = ["password", "Token", "=", ":", " ", '"', "'", "AKIA", "ABCD1234", "abcdef0123", "api_key", "apikey", "secret", "ſecret", "toKen", "x", "\n", "deadbeef00", "PASSWD", "/_."]
    texts = [t for _, t, _ in small] + ["".join(random.choice(bits) for _ in range(random.randint(0, 25))) for _ in range(3000)]
    for t in texts:
        assert [s for s in secrets.spans_of(t) if s[1] < 3] == base_spans(t)


def test_checksums_decide():
    body = "Zx81Qw7Tn5Lm3Vb9Hg2Kd6Rf4Js0Yp"
    token = "ghp_" + body + secrets.base62_crc32(body)
    assert secrets.spans_of(f"x {token}.") == [(2, 3, 42)]
    wrong = token[:-1] + ("0" if token[-1] != "0" else "1")
    assert secrets.spans_of(wrong) == [] and secrets.spans_of(token + "z") == []


def test_secrets_awkward_rows(spark):
    got = secrets.scan_secrets(documents(spark)).collect()
    assert len(got) == len(ROWS) and all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got if r.doc_id in (1, 2))
    assert secrets.scan_secrets(empty(spark)).count() == 0


# 10 -----------------------------------------------------------------------------------------------

def test_patience_and_moved_blocks():
    assert line_dedup.patience([1, 2, 3, 4], [0, 2, 3, 9, 4]) == [(1, 1), (2, 2), (3, 4)]
    assert line_dedup.aligned_lines([1, 2, 3, 4, 5], [30] * 5, [4, 5, 1, 2], 25) == [0, 1, 3, 4]
    random.seed(1)
    for _ in range(500):
        a, b = ([random.randint(0, 6) for _ in range(random.randint(0, 12))] for _ in "ab")
        p = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in p) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(p, p[1:], strict=False))
        assert {a[i] for i in line_dedup.aligned_lines(a, [30] * len(a), b, 25)} == set(a) & set(b)


def test_blocks_that_an_alignment_passes_over():
    assert line_dedup.aligned_lines([1, 2, 3, 11, 12, 13, 14], [20, 20, 20, 3, 3, 3, 3], [11, 12, 13, 14, 1, 2, 3], 25) == [0, 1, 2]
    assert line_dedup.aligned_lines([1, 11, 12], [60, 3, 3], [11, 12, 1], 25) == [0]
    random.seed(2)
    for _ in range(500):
        size = [random.randint(1, 30) for _ in range(9)]
        a, b = ([random.randint(0, 8) for _ in range(random.randint(0, 12))] for _ in "ab")
        both = [(i, j) for i in range(len(a)) for j in range(i + 1, len(a) + 1) if sum(size[x] for x in a[i:j]) >= 25 and any(b[k : k + j - i] == a[i:j] for k in range(len(b)))]
        assert line_dedup.aligned_lines(a, [size[x] for x in a], b, 25) == sorted({x for i, j in both for x in range(i, j)})


def passage(k, words=60):
    return " ".join(f"p{k}_{i}" for i in range(words))


def test_passages_go_from_later_documents(spark):
    own = lambda k: "\n".join(" ".join(f"o{k}_{j}_{i}" for i in range(20)) for j in range(4))
    half = passage(2).replace(" p2_30", "\np2_30")  # on two lines of 30 words
    docs = [(0, own(0) + "\n" + passage(1)), (1, passage(1) + "\n" + own(1) + "\n" + half), (2, own(2)), (3, half + "\n" + own(3) + "\n" + passage(1)), (4, own(2)), (5, own(5) + "\nshort line\n"), (6, "short line\n" + own(6))]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == {0: docs[0][1], 1: own(1) + "\n" + half, 2: own(2), 3: own(3), 4: "", 5: docs[5][1], 6: docs[6][1]}


def test_rare_lines_between_edited_ones(spark):
    line = lambda k, words=12: " ".join(f"r{k}_{i}" for i in range(words))
    copy = "\n".join(line(i) if i % 2 else line(f"e{i}") for i in range(8))
    poem = [line(i, 3) for i in range(100, 108)]  # rare lines of three words, that only together make a pair
    often = line("often")
    docs = [(0, "\n".join(map(line, range(8)))), (1, copy), (2, "\n".join(poem)), (3, "\n".join(x if i % 2 else line(f"v{i}", 3) for i, x in enumerate(poem))), (4, line(100, 3))]
    docs += [(k, line(f"own{k}") + "\n" + often) for k in range(10, 21)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)).collect()}
    want = dict(docs) | {1: "\n".join(line(f"e{i}") for i in (0, 2, 4, 6)), 3: "\n".join(line(f"v{i}", 3) for i in (0, 2, 4, 6))}
    assert got == want  # what eleven documents have is not rare, and three words are no pair
    twice = spark.createDataFrame([d for d in docs if d[0] < 20 for _ in range(3)], "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(twice).collect()}
    assert got[11] == line("own11") and got[1] == want[1]  # copies of a row are one document


def removable(docs):
    """{id: numbers of lines that go}, by comparing each document with all earlier ones."""
    lines = {k: [(i, " ".join(x.split())) for i, x in enumerate(t.split("\n")) if x.split()] for k, t in docs}
    words = lambda x: len(x.split())
    holders = collections.defaultdict(list)
    for k, _ in docs:
        for x in {x for _, x in lines[k]}:
            holders[x].append(k)
    rare = {x for x, ks in holders.items() if 2 <= len(ks) <= 10 and words(x) < 25}
    out = collections.defaultdict(set)
    for n, (k, _) in enumerate(docs):
        mine = [x for _, x in lines[k]]
        first = collections.Counter()
        for x in rare & {*mine}:
            if holders[x][0] != k:
                first[holders[x][0]] += words(x)
        for e, _ in docs[:n]:
            theirs = [x for _, x in lines[e]]
            long = False
            for i in range(len(mine)):
                for j in range(len(theirs)):
                    m = 0
                    while i + m < len(mine) and j + m < len(theirs) and mine[i + m] == theirs[j + m]:
                        m += 1
                    if sum(words(x) for x in mine[i : i + m]) >= 25:
                        long = True
                        out[k] |= {lines[k][i + a][0] for a in range(m)}
            if long or first[e] >= 8:
                out[k] |= {i for i, x in lines[k] if x in rare and x in {*theirs}}
    return out


def test_line_dedup_against_all_pairs(spark, small):
    docs = [(k, t) for k, t, _ in small]
    want = removable(docs)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.key.id: {*r.lines} for r in line_dedup.dropped_lines(df).collect()}
    assert got.keys() == want.keys() and sum(map(len, want.values())) > 100
    text = dict(docs)
    for k, lines in want.items():
        assert got[k] <= lines
        left = [text[k].split("\n")[i] for i in lines - got[k]]  # ends of runs that the first holder of their parts lacks
        assert sum(len(x.split()) for x in left) < 25


@pytest.mark.parametrize("deal", [1, 7])
def test_a_first_document_of_many(spark, monkeypatch, deal):
    monkeypatch.setattr(line_dedup, "DEAL", deal)
    docs = [(k, f"own line of number {k}\n" + passage(1) + "\n" + (passage(2) if k % 3 else "")) for k in range(60)]
    got = {r.doc_id: r.text.strip("\n") for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    first = {0: docs[0][1].strip("\n"), 1: "own line of number 1\n" + passage(2)}
    assert got == {k: first.get(k, f"own line of number {k}") for k in range(60)}


def test_line_dedup_many_repeats_and_long_words(spark):
    import time

    began = time.time()
    random.seed(4)
    lines = "\n".join(f"value {random.randint(0, 3)} of four" for _ in range(4000))
    docs = [(1, lines), (2, "x" * 1_000_000), (3, "own\n" + lines), (4, "x" * 1_000_000)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got[1] == lines and got[3] == "own" and time.time() - began < 60


def test_line_dedup_awkward_rows(spark):
    got = line_dedup.dedup_lines(documents(spark)).collect()
    assert len(got) == len(ROWS)
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r.text)
    assert by[1] == [None] and by[4] == ["one two three four five six"] * 2 and by[6] == [LONG] and by[7] == [LONG + " end"]
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


# pipeline -----------------------------------------------------------------------------------------

def test_pipeline(spark):
    import corpus_pipeline

    docs, sizes = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == docs.columns
            docs = written(out)
            sizes.append(docs.count())
    assert sizes[0] < 200 and sizes[1] == sizes[0] and sizes[2] < sizes[1]
    ids = sorted((r.doc_id, r.ids_sha256) for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect())
    assert ids == sorted((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect())


def test_pipeline_awkward_rows(spark):
    import corpus_pipeline

    for docs in (documents(spark), empty(spark)):
        rows_ = docs.count()
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            if k < 4:
                assert out.columns == docs.columns, name
            n = written(out).count()
            assert n == rows_ if name in ("lines", "encoding") else n <= 2 * rows_
            assert rows_ == 0 or n > 0, name
