"""Rows that the near-copy join makes before pairs are tested."""

import numpy as np
import pytest

from contactloom.llm import ngram_join


def family(rng, members, words, edits, name):
    """Texts of one origin, each with own edits."""
    base = [f"{name}{k}" for k in range(words)]
    out = []
    for m in range(members):
        own = list(base)
        for at in rng.choice(words, edits, replace=False):
            own[at] = f"{name}e{m}x{at}"
        out.append(" ".join(own))
    return out


def joined(spark, texts, gram, share):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets, levels = ngram_join.profile(docs, gram)
    posted = ngram_join.shared_postings(docs, levels, gram, share)
    nobody = spark.createDataFrame([], "node bigint, root bigint")
    return posted, ngram_join.open_postings(posted, nobody)


@pytest.mark.parametrize("gram, share", [(3, 90), (5, 80)])
def test_pairs_meet_about_once_and_no_link_is_lost(spark, gram, share):
    rng = np.random.default_rng(3)
    texts = [t for k, (words, edits) in enumerate([(9, 1), (130, 1), (400, 3), (400, 8), (900, 7), (2500, 20)]) for t in family(rng, 8, words, edits, f"f{k}w")]
    _, open_ = joined(spark, texts, gram, share)
    known = ngram_join.WordHashes()
    sets = [ngram_join.gram_hashes(t.encode(), gram, known) for t in texts]
    nodes = [ngram_join.node_of(h) for h in sets]
    links = set()
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            both = np.intersect1d(x, y).size
            if nodes[i] != nodes[j] and 100 * both >= share * (len(x) + len(y) - both):
                links.add((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
    pairs = ngram_join.other_pairs(open_, share).collect()
    met = ngram_join.met_pairs(open_, share).count()
    assert len(links) > 40 and links <= {(r["a"], r["b"]) for r in pairs}
    assert len(pairs) <= met <= 3 * len(pairs)  # a pair was met at each of its common first n-grams before, up to some 250


def test_postings_without_a_possible_partner_are_dropped(spark):
    """Unlike texts share rare n-grams, some of them many; nothing of them is paired."""
    rng = np.random.default_rng(4)
    strangers = [" ".join([f"s{k}w{i}" for i in range(60)] + ["one", "line", "of", "all"]) for k in range(30)]
    posted, _ = joined(spark, strangers + family(rng, 3, 130, 1, "near"), 3, 90)
    assert posted.select("node").distinct().count() == 3


@pytest.mark.parametrize("gram, share", [(3, 90), (5, 80)])
def test_wide_sketches_drop_unlike_long_sets_only(spark, gram, share):
    rng = np.random.default_rng(5)
    texts = family(rng, 2, 700, 5, "near") + family(rng, 2, 7000, 40, "long") + family(rng, 2, 700, 90, "far") + family(rng, 2, 7000, 900, "wide")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets, _ = ngram_join.profile(docs, gram)
    own = sets.selectExpr("node", "n_shingles AS size", "wide")
    node = {r["doc_id"]: r["node"] for r in sets.collect()}
    pairs = spark.createDataFrame([(i, node[i], node[i + 1]) for i in (0, 2, 4, 6)] + [(9, node[0], node[2])], "gram bigint, a bigint, b bigint")
    assert {r["gram"] for r in ngram_join.wide_pairs(pairs, own, share).collect()} == {0, 2, 9}  # 9: lengths of sketches differ
