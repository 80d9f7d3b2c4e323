import random

import pytest

from tessera.llm import line_dedup


def test_heaviest_chain_against_all_chains():
    r = random.Random(3)
    for _ in range(300):
        n = r.randint(0, 8)
        places, weights = r.sample(range(20), n), [r.randint(1, 9) for _ in range(n)]
        most = max((sum(weights[k] for k in range(n) if m >> k & 1) for m in range(2**n) if all(places[i] < places[j] for i in range(n) for j in range(i + 1, n) if m >> i & 1 and m >> j & 1)), default=0)
        chain = line_dedup.heaviest_chain(places, weights)
        assert chain == sorted(chain) and all(places[x] < places[y] for x, y in zip(chain, chain[1:], strict=False))
        assert sum(weights[k] for k in chain) == most


def test_rare_lines_go_in_aligned_blocks_only():
    lines = [1, 2, 3, 4, 5]
    assert line_dedup.aligned_lines(lines, [6] * 5, [1, 9, 2, 8, 3], 25, rare=[1, 2, 3]) == [0, 1, 2]
    assert line_dedup.aligned_lines([1, 2, 3], [9, 5, 5], [2, 3, 1], 25, rare=[1, 2, 3]) == [1, 2]  # the other order weighs less
    assert line_dedup.aligned_lines([1, 2, 3], [11, 5, 5], [2, 3, 1], 25, rare=[1, 2, 3]) == [0]
    assert line_dedup.aligned_lines([7, 1, 2, 3], [6, 9, 9, 9], [1, 2, 3, 7], 25, rare=[7]) == [1, 2, 3]  # a passage goes, a moved rare line stays
    assert line_dedup.aligned_lines([1, 2], [6, 6], [1, 2], 25, rare=[2]) == [1]


def test_moved_passages_go():
    a, b, c = [1, 2, 3], [4, 5, 6], [7, 8, 9]
    words = [10] * 9
    assert line_dedup.aligned_lines(a + b + c, words, c + b + a, 25) == [*range(9)]
    assert line_dedup.aligned_lines(a + [50] + c, words[:7], c + [51] + a, 25) == [0, 1, 2, 4, 5, 6]
    assert line_dedup.aligned_lines(a + a, words[:6], a, 25) == [*range(6)]


def test_nothing_goes_without_the_alignment(monkeypatch):
    r = random.Random(5)
    cases = [([r.randint(0, 30) for _ in range(12)], [r.randint(0, 30) for _ in range(12)]) for _ in range(200)]
    assert any(line_dedup.aligned_lines(a, [30] * 12, b, 25, a) for a, b in cases)
    monkeypatch.setattr(line_dedup, "patience", lambda *a: [])
    assert not any(line_dedup.aligned_lines(a, [30] * 12, b, 25, a) for a, b in cases)


@pytest.mark.parametrize("settings", [{"rare_docs": 1}, {"link_words": 40}])
def test_what_is_rare_and_links_is_a_setting(spark, settings):
    line = lambda k: " ".join(f"w{k}_{i}" for i in range(10))
    docs = spark.createDataFrame([(1, line(1) + "\n" + line(2)), (2, line(1) + "\n" + line(3))], "doc_id bigint, text string")
    assert line_dedup.dedup_lines(docs).where("n_removed > 0").count() == 1
    assert line_dedup.dedup_lines(docs, **settings).where("n_removed > 0").count() == 0
