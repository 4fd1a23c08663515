"""Registered queries against their SQL, and the pipeline stage by stage."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import differences, duck
from tidemark.llm import jaccard, mixing, quality, substrings
from tidemark.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf_dir, name):
    con = duck(sf_dir)
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    assert differences(QUERIES[name](spark, sf_dir), ORACLES[name], con) == []


def test_a_query_for_each_operator():
    assert [n.split("_")[0] for n in QUERIES if n.startswith("op")].__len__() == 13
    assert len(corpus_pipeline.STAGES) == 5


def plain_units(text):
    """(unit, normalised form) of each sentence, by walking through the signs."""
    out, unit = [], ""
    for i, c in enumerate(text):
        if c == "\n":
            out.append(unit)
            unit = ""
            continue
        blank = c in " \t\x0b\x0c\r"
        mark = unit.rstrip(" \t\x0b\x0c\r")[-1:]
        if not blank and unit and unit[-1] in " \t\x0b\x0c\r" and mark and mark in ".!?。":
            out.append(unit)
            unit = ""
        unit += c
    return [(u, " ".join(u.lower().split())) for u in [*out, unit]]


def test_pipeline_by_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    passed = quality.filtered(docs)
    kept = {r.doc_id for r in quality.judged(docs).where("kept").collect()}
    assert {r.doc_id for r in passed.collect()} == kept
    one = jaccard.representatives(passed)
    labels = {r.doc_id: r.component_id for r in jaccard.joined(passed, size=5, percent=80).collect()}
    assert {r.doc_id for r in one.collect()} == set(labels.values())
    units = Counter(f for r in substrings.documents(one).collect() for _, f in plain_units(r.text) if len(f) >= 50)
    assert max(units.values()) == 1
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "lang", "source", "n_chars", "ids", "exact"} == set(out.columns)
    assert out.where("NOT exact").count() == 0 and out.count() > 0


def test_short_later_lines_go_where_every_unit_counts(spark):
    long = "every word of this line is counted by both rules"
    rows = [(1, f"one two\n{long}\n\nOK"), (2, f"first\n{long}\nok\n\nlast"), (3, "重复的段落"), (4, "重复的段落\nnew"), (5, " ONE  two ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.lit(0).cast("long"))
    got = {r.doc_id: r.text for r in substrings.documents(docs, min_chars=1).collect()}
    assert got == {1: rows[0][1], 2: "first\n\nlast", 3: rows[2][1], 4: "new"}


def test_pipeline_cuts_later_sentences_within_lines(spark):
    passage = "This sentence is long enough to be one that nobody writes twice. And so is the somewhat longer sentence that follows it here!"
    unspaced = "没有空格的文字也要按长度计算" * 4
    rows = [
        (1, f"One begins. {passage} One ends"),
        (2, f"Two\nbegins otherwise. {passage}  Two ends.\n\nTwo"),
        (3, f"{passage}\n\n"),
        (4, "\n\n"),
        (5, f"{unspaced}。 x"),
        (6, f"y\n{unspaced}。"),
        (7, "One begins."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.lit(0).cast("long"))
    got = {r.doc_id: (r.text, r.n_chars) for r in dict(corpus_pipeline.STAGES)["substring dedup"](spark, docs, "").collect()}
    want = {1: rows[0][1], 2: "Two\nbegins otherwise. Two ends.\n\nTwo", 5: rows[4][1], 6: "y", 7: "One begins."}
    assert got == {i: (t, len(t)) for i, t in want.items()}


def test_stages_against_plain_python(spark, sf_dir):
    """Stages 2 to 5 on documents that passed the first, each against its input."""
    stages = dict(corpus_pipeline.STAGES)
    read = spark.read.parquet(f"{sf_dir}/documents.parquet")
    passed = spark.createDataFrame(stages["quality rules"](spark, read, sf_dir).collect(), read.schema)
    docs = sorted(passed.collect(), key=lambda r: r.doc_id)
    # 2: the smallest id of each group linked by shingles of five words.
    words = [(r.text or "").lower().split() for r in docs]
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in words]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    want = [docs[i] for i in range(len(docs)) if find(i) == i]
    one = stages["n-gram Jaccard join"](spark, passed, sf_dir).collect()
    assert sorted((r.doc_id, r.text) for r in one) == [(r.doc_id, r.text) for r in want]
    # 3: no sentence of 50 signs or more that an earlier document holds.
    seen, cut = set(), []
    for r in want:
        kept = []
        for line in r.text.split("\n"):
            parts = plain_units(line)
            left = []
            for unit, form in parts:
                if len(form) < 50 or form not in seen:
                    left.append(unit)
                seen.add(form)
            if left or not line:
                kept.append("".join(left))
        if "".join(kept).strip():
            cut.append((r.doc_id, "\n".join(kept)))
    deduped = stages["substring dedup"](spark, spark.createDataFrame(one, read.schema), sf_dir).collect()
    assert sorted((r.doc_id, r.text) for r in deduped) == cut
    # 4: the wanted words of each source, no document more than twice.
    mix = stages["mixing sources"](spark, spark.createDataFrame(deduped, read.schema), sf_dir).collect()
    given = Counter(r.doc_id for r in deduped)
    assert all(n <= 2 * given[i] for i, n in Counter(r.doc_id for r in mix).items())
    sources = sorted({r.source for r in deduped}, key=lambda s: (s is None, s or ""))
    count = lambda rows, s: sum(len(r.text.split()) for r in rows if r.source == s)
    plan = mixing.Plan()
    for s, target in zip(sources, mixing.targets([count(deduped, s) for s in sources], plan), strict=True):
        assert abs(count(mix, s) - target) <= 2 * plan.block_words
    # 5: a row for each row.
    out = stages["SentencePiece"](spark, spark.createDataFrame(mix, read.schema), sf_dir).collect()
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in mix)
    assert all(r.exact and len(r.ids) > 0 for r in out)
