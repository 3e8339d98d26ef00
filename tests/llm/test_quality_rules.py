"""Quality rules against plain Python."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from reelhouse.llm import quality_rules as q
from reelhouse.llm.common import likely_among

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def bucket(rules, *words):
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed)
    signed = seed - (1 << 64) if seed >= 1 << 63 else seed
    return signed % rules.buckets


def grams(text, rules):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [bucket(rules, x) for x in w] + [bucket(rules, a, b) for a, b in zip(w, w[1:])]


def plain(docs, good, rules):
    """Weights of all buckets and the threshold, from rows (id, text) and the trusted ids."""
    raw, halves = Counter(), (Counter(), Counter())
    half = lambda i: xxhash.xxh64_intdigest(str(i).encode(), 42) % 2
    own = {}
    for n, (i, t) in enumerate(docs):
        own[n] = grams(t, rules)
        raw.update(own[n])
        if i in good:
            halves[half(i)].update(own[n])
    n_raw = sum(raw.values())

    def weight(counts):
        n = sum(counts.values())
        return lambda b: math.log((counts[b] + rules.prior) / (raw[b] * n / n_raw + rules.prior)) if n else 0.0

    of_others = [weight(halves[1]), weight(halves[0])]
    held = []
    for n, (i, t) in enumerate(docs):
        m = measures(t)
        if i in good and m[0] >= 50 and 100 * m[4] <= 50 * m[0]:
            held.append(sum(map(of_others[half(i)], own[n])) / max(1, len(own[n])))
    known = held and all(sum(h.values()) for h in halves)
    return weight(halves[0] + halves[1]), float(np.quantile(held, rules.rejected)) if known else None


def test_measures_and_scores_agree_with_plain_python(spark, small):
    rules = q.Rules(buckets=512, trusted=10_000, rejected=0.1)
    docs, labels = small["documents"], small["labels"]
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and r.toxic == 0}
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    weight, threshold = plain(texts, good, rules)
    assert q.fit(docs, labels, rules).threshold == pytest.approx(threshold, abs=2e-6)
    rows = {r.doc_id: r for r in q.judged(docs, labels, rules).drop("doc", "text").collect()}
    assert len(rows) == len(texts)
    for i, t in texts:
        expected = measures(t)
        assert tuple(rows[i][c] for c in NAMES) == expected
        own = grams(t, rules)
        score = sum(map(weight, own)) / max(1, len(own))
        assert rows[i].score == pytest.approx(score, abs=2e-6)
        failed = expected[0] < 50 or 100 * expected[4] > 50 * expected[0]
        assert rows[i].base_failed == failed
        if abs(score - threshold) > 1e-5:
            assert rows[i].kept == (not failed and score >= threshold)


def is_junk(text):
    words = text.split()
    return len(re.findall(r"[*$%&#]{3}(?=\s)", text)) > 0.2 * len(words) or text.count(" | ") > 0.2 * len(words)


@pytest.mark.parametrize("labelled", [100, 10**6])
def test_junk_goes_whatever_the_number_of_labels(spark, labelled):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    good = labels.where("quality = 1 and toxic = 0").orderBy("doc_id").limit(labelled)
    rows = [r for r in q.judged(docs, good).select("text", "base_failed", "kept").collect() if not r.base_failed]
    junk, prose = [r.kept for r in rows if is_junk(r.text)], [r.kept for r in rows if not is_junk(r.text)]
    assert len(junk) > 50 and sum(junk) <= 0.15 * len(junk)
    assert sum(prose) >= (0.99 if labelled > 100 else 0.85) * len(prose)


def test_without_a_threshold_all_that_pass_the_plain_rules_stay(small):
    labels = small["labels"].where("quality = 1 and toxic = 0")
    one = labels.limit(1)
    for few in (labels.limit(0), one, one.union(one)):
        assert q.fit(small["documents"], few).threshold is None
        assert all(r.kept != r.base_failed for r in q.judged(small["documents"], few).select("kept", "base_failed").collect())


@pytest.mark.parametrize(
    "text",
    ["a b c a b c", "a b c d a b c", "a a a a a", "a b", "", None, "x a b a b a y", "a b c x\na b c x\n\n \na b c x", "a b c q w e a b c r a b c q w e"],
)
def test_repeats(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    columns = q.base_measures(F.col("text"), q.words_of(F.col("text")), q.Rules())
    row = docs.select(*[c.alias(n) for n, c in columns.items()]).first()
    assert tuple(row[c] for c in NAMES) == measures(text)


def test_edge_rows_each_come_once(small, edge_docs, no_docs):
    rows = q.judged(edge_docs, small["labels"]).drop("doc").collect()
    assert len(rows) == 14
    for r in rows:
        assert tuple(r[c] for c in NAMES) == measures(r.text)
    kept = q.keep_good(edge_docs, small["labels"])
    assert kept.columns == edge_docs.columns and kept.count() == sum(r.kept for r in rows)
    assert q.keep_good(no_docs, small["labels"]).count() == 0
    assert q.judged(edge_docs, small["labels"].limit(0)).where("score <> 0").count() == 0


def test_junk_goes_and_prose_stays(small):
    labels = {r.doc_id: r.quality for r in small["labels"].collect()}
    rows = q.judged(small["documents"], small["labels"]).drop("doc").collect()
    prose = [r for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert prose and all(r.kept for r in prose)
    pipes = [r for r in rows if r.text.count(" | ") > 0.3 * r.n_words]
    assert pipes and not any(r.kept for r in pipes)


def test_no_python_in_the_plan(small):
    plan = q.judged(small["documents"], small["labels"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_all_trusted_documents_count_whatever_the_bound(small):
    docs, labels = small["documents"], small["labels"]
    of_few, of_all = (q.fit(docs, labels, q.Rules(buckets=512, trusted=n, rejected=0.1)) for n in (10, 10_000))
    assert of_few == of_all


@pytest.mark.parametrize("share", [0.0, 0.002, 0.1, 0.5, 1.0])
def test_the_quantile_is_that_of_percentile(spark, share):
    for rows in ([(0.0,)], [(-1.5,), (2.25,)], [(round(math.sin(i) * i / 7, 6),) for i in range(500)] + [(0.000001,), (-0.000001,)] * 40):
        scores = spark.createDataFrame(rows, "score double")
        assert q._quantile(scores, share) == scores.agg(F.percentile("score", share)).first()[0]
    assert q._quantile(scores.limit(0), share) is None


def test_plans_hold_no_weights_as_text_and_rows_no_copy_of_them(small):
    docs, labels = small["documents"], small["labels"]
    for df in (q.judged(docs, labels), q.keep_good(docs, labels)):
        plan = df._jdf.queryExecution()
        assert len(plan.toString()) < 100_000  # about a million characters a use with the weights in it
        assert " AS weights" not in plan.optimizedPlan().toString()


@pytest.mark.parametrize("n, most_bits", [(1, 1 << 26), (3000, 1 << 26), (3000, 1 << 15), (20_000, 1 << 15)])
def test_rows_likely_among_ids_have_all_that_are(spark, n, most_bits):
    key = F.concat(F.lit("é"), F.col("id").cast("string")).alias("key")
    ids = spark.range(0, 40 * n, 40).select(key)
    rows = spark.range(40_000).select("id", key)
    rows = rows.union(rows.where("id = 0")).union(rows.where("id = 1").select("id", F.lit(None)))
    found = [r.id for r in likely_among(rows, ids, "key", most_bits).collect()]
    right = [0, *range(0, min(40_000, 40 * n), 40)]
    assert sorted(i for i in found if i % 40 == 0 and i < 40 * n) == right
    if 16 * n <= most_bits:
        assert len(found) - len(right) < 0.09 * 40_000


def test_few_texts_of_other_documents_are_shuffled(spark, monkeypatch):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b c "), F.col("id").cast("string")).alias("text"))
    labels = docs.where("doc_id % 20 = 0").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    shuffled = []

    def sizes(plan):
        if plan.nodeName() == "Exchange" and "text" in plan.output().mkString(","):
            shuffled.append(plan.metrics().apply("shuffleRecordsWritten").value())
        for i in range(plan.children().size()):
            sizes(plan.children().apply(i))

    def written(df, name, write=q.written):
        if name == "trusted":
            adaptive = spark.conf.get("spark.sql.adaptive.enabled")
            spark.conf.set("spark.sql.adaptive.enabled", "false")
            try:
                assert len(df.collect()) == 200
                sizes(df._jdf.queryExecution().executedPlan())
            finally:
                spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        return write(df, name)

    monkeypatch.setattr(q, "written", written)
    q.fit(docs, labels, q.Rules(buckets=512))
    assert len(shuffled) == 1 and 200 <= shuffled[0] < 600
