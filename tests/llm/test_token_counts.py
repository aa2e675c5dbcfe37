import numpy as np
import public_tokenizers
import pytest

from chronopanel.llm import token_counts as T

from .helpers import AWKWARD, documents

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def brute(start, end, lo, hi, rule):
    counts = [0.0] * (len(lo) + 1)
    for s, e in zip(start, end):
        held = [max(0, min(e, h) - max(s, a)) for a, h in zip(lo, hi)]
        none = e - s - sum(held)
        if rule == "share":
            for k, x in enumerate(held):
                counts[k] += x / (e - s)
            counts[-1] += none / (e - s)
        elif rule == "most":
            k = max(range(len(held)), key=lambda k: (held[k], -k), default=-1)
            counts[-1 if k < 0 or held[k] < none else k] += 1
        else:
            at = s if rule == "first" else e - 1
            counts[next((k for k, (a, h) in enumerate(zip(lo, hi)) if a <= at < h), -1)] += 1
    return counts


@pytest.mark.parametrize("rule", T.RULES)
def test_attribution_against_brute_force(rule):
    g = np.random.default_rng(4)
    for _ in range(60):
        end = np.cumsum(g.integers(1, 6, 30))
        start = np.r_[0, end[:-1]]
        cut = np.sort(g.choice(end[-1] + 1, 2 * g.integers(0, 8), replace=False))
        lo, hi = cut[::2].astype(np.int64), cut[1::2].astype(np.int64)
        counts, _ = T.attribute(start, end, lo, hi, rule)
        assert np.allclose(counts, brute(start, end, lo, hi, rule))


def test_lines_sum_to_the_whole_text(spark):
    tokens = T.ByteTokens(VOCABULARY)
    out = T.count_tokens(documents(spark), VOCABULARY).collect()
    for i, t, *_ in AWKWARD:
        own = [r for r in out if r["id"] == i]
        copies = sum(a[0] == i for a in AWKWARD)
        assert sum(r["n_tokens"] for r in own) == copies * (len(tokens.lengths(t)) if t else 0)
        assert len(own) == copies * max(1, len((t or "").rstrip("\n").split("\n")) if (t or "").endswith("\n") else len((t or "").split("\n")))
        assert max(r["end"] for r in own) == len(t or "")


def test_given_sections(spark):
    rows = [(0, "The title here\nBody text follows.", [("title", 0, 14), ("body", 15, 33)]), (1, None, [("title", 0, 0)]), (2, "no sections", None),
            (3, "é𝔘 wide characters", [("a", 0, 1), ("b", 1, 2)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, s array<struct<name:string,start:long,end:long>>")
    for rule in T.RULES:
        out = T.count_tokens(df, VOCABULARY, sections_col="s", rule=rule).collect()
        tokens = T.ByteTokens(VOCABULARY)
        for i, t, _ in rows:
            assert abs(sum(r["n_tokens"] for r in out if r["id"] == i) - (len(tokens.lengths(t)) if t else 0)) < 1e-9
        assert {r["section"] for r in out if r["id"] == 2} == {-1}
        assert [(r["name"], r["n_tokens"]) for r in out if r["id"] == 1] == [("title", 0.0)]
    with pytest.raises(ValueError):
        T.count_tokens(df, VOCABULARY, rule="other")


def test_long_white_space_is_encoded():
    tokens = T.ByteTokens(VOCABULARY)
    assert tokens.lengths(" " * 400_000).sum() == 400_000


def test_empty_table(spark):
    assert T.line_token_counts(spark, documents(spark).limit(0)).collect() == []
