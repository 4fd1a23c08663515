"""The operators on odd rows, and against brute force."""

import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import (
    chat,
    jaccard,
    language,
    metric_tree,
    mixing,
    pages,
    quality,
    sentencepiece,
    substrings,
    toxicity,
)
from tidemark.llm.queries import QUERIES
from tidemark.session import stored

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
rng = random.Random(5)
VOCABULARY = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]


def prose(n, seed):
    return " ".join(random.Random(seed).choices(VOCABULARY, k=n))


@pytest.fixture(scope="module")
def docs(spark):
    shared = prose(60, "shared")
    rows = [(i, f"{prose(40, i)}\n{prose(30, i + 1000)}", "en", f"s{i % 3}", 1) for i in range(40)]
    rows += [(100 + i, f"{prose(30, i + 5000)}\n{shared}", "en", "s0", 1) for i in range(30)]
    base = prose(120, "base").split()
    for i in range(12):
        copy = list(base)
        copy[i * 9] = "changed"
        rows.append((200 + i, " ".join(copy), "en", "s1", 1))
    rows += [(5, rows[5][1], "en", "s2", 1)] * 2  # a repeated row
    rows += [(300, None, None, None, None), (301, "", "en", None, 0), (None, prose(50, "n"), "en", "s1", 1)]
    rows += [(302, "one two", "de", "s1", 7), (303, " \t\n\x0b ", "de", "s1", 5), (304, prose(20_000, "long"), "en", "s2", 1)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


def plain_words(text):
    return (text or "").encode().split()


# Quality rules


def test_counts_by_brute_force(spark, docs):
    texts = ["a b c d e f g h i a b c d e f g h j", "x " * 30, "#a $\nq\nq\n\n \n \nq", "", "é% " * 9, "a b c d e f g h " * 3]
    rows = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], "doc_id int, text string, source string")
    got = {r.doc_id: r for r in quality.judged(rows).collect()}
    for i, t in enumerate(texts):
        w = plain_words(t)
        windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = {j for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
        lines = [x for x in t.split("\n") if x.split()]
        want = (len(w), len(b"".join(w).decode()), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w))


def test_frequent_lines_go_and_depleted_documents_are_rejected(spark):
    line = "read more news on our front page today"
    rows = [(i, f"{prose(40, i)}\n{line.upper()}", "h") for i in range(30)]
    rows += [(50, f"{line}\n{prose(22, 50)}\n{line}\n{line}\n{line}\n{line}", "h"), (51, f"{prose(40, 51)}\n{line}", "other")]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string")
    got = {r.doc_id: r for r in quality.judged(df, keep_text=True).collect()}
    assert all(got[i].kept and got[i].cleaned == prose(40, i) and got[i].removed_words == 8 for i in range(30))
    assert not got[50].kept and got[51].kept and got[51].removed_words == 0
    assert quality.filtered(df).count() == 31


def test_filtering_writes_no_text(spark, docs, monkeypatch):
    written = []
    monkeypatch.setattr(quality, "stored", lambda df, label: written.append(df.columns) or stored(df, label))
    line = "read more news on our front page today"
    more = [(400 + i, f"{prose(40, i + 400)}\n{line}", "en", None, 1) for i in range(30)]
    more += [(400, more[0][1], "en", None, 1), (400, more[0][1], "de", None, 2), (400, more[0][1], "en", "s9", 3)]
    rows = docs.union(spark.createDataFrame(more, DOCS))
    got = Counter(map(tuple, quality.filtered(rows).collect()))
    assert written and not {"text", "row"} & set(written[0])
    judged = [r for r in quality.judged(rows, keep_text=True).collect() if r.kept]
    assert got == Counter((r.doc_id, r.cleaned, r.lang, r.source, len(r.cleaned)) for r in judged)
    # Copies, rows under one id and a null host keep their own columns; the host of one row has no frequent line.
    assert got[400, prose(40, 400), "en", None, len(prose(40, 400))] == 2
    assert got[400, prose(40, 400), "de", None, len(prose(40, 400))] == 1
    assert got[400, more[0][1], "en", "s9", len(more[0][1])] == 1


def test_quality_of_odd_rows(spark, docs):
    got = quality.judged(docs).collect()
    assert len(got) == docs.count()
    by = {r.doc_id: r for r in got}
    assert by[300].n_words == 0 and by[300].base_failed and not by[301].kept and by[304].kept
    assert quality.judged(docs.limit(0)).count() == 0
    clash = docs.withColumns({"kept": F.lit("x"), "row": F.lit(1), "words": F.lit(2), "host": F.lit(3)})
    assert quality.judged(clash).where("kept").count() == sum(r.kept for r in got)


# Substrings


def test_later_lines_go_with_their_offsets(spark):
    a, b, c = (prose(12, k) for k in "abc")
    rows = [(2, f"{a}\n{b}"), (1, f"{b.upper()}  \nshort\nshort"), (3, f"{c}\n{c}\n\nx"), (None, c), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("doc", F.lit(0))
    got = {r.doc_id: (r.text, [tuple(s) for s in r.removed]) for r in substrings.deduplicated(df).collect()}
    assert got[1] == (f"{b.upper()}  \nshort\nshort", [])
    assert got[2] == (a, [(len(a) + 1, len(a) + 1 + len(b))])
    assert got[3] == (f"{c}\n\nx", [(len(c) + 1, 2 * len(c) + 1)])
    assert got[None][0] == "" and got[4] == (None, []) and got[5] == ("", [])
    assert substrings.deduplicated(df.limit(0)).count() == 0


# Jaccard


def shingles(text, size):
    w = plain_words((text or "").lower())
    return frozenset([tuple(w)] if 0 < len(w) < size else [tuple(w[k : k + size]) for k in range(len(w) - size + 1)])


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80), (2, 60)])
def test_components_by_brute_force(spark, size, percent):
    rows = []
    for g in range(12):
        base = prose(rng.choice([3, 9, 25, 80, 300]), ("g", g)[1] + 9000).split()
        for c in range(rng.choice([1, 2, 30])):
            copy = [w if random.Random(g * 1000 + c * 10 + i).random() > 0.02 * (c % 5) else "zz" for i, w in enumerate(base)]
            rows.append((len(rows), " ".join(copy)))
    rows += [(1000, None), (1001, ""), (1002, "a b"), (1003, "A  B")]
    sets = {i: shingles(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.joined(df, size=size, percent=percent).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in sets}
    kept = {r.doc_id for r in jaccard.representatives(df, size=size, percent=percent).collect()}
    assert kept == {find(i) for i in sets}


def test_t_occurrence_counts():
    from array import array

    random_ = random.Random(3)
    lists = [array("i", sorted(random_.sample(range(60), random_.randint(1, 50)))) for _ in range(40)]
    counts = Counter(i for x in lists for i in x)
    for least in (1, 5, 20, 33, 41):
        assert jaccard.t_occurrence(lists, least) == {i: n for i, n in counts.items() if n >= least}


def test_jaccard_of_odd_rows(spark, docs):
    assert jaccard.joined(docs).count() == docs.count()
    assert jaccard.representatives(docs).where("doc_id = 5").count() == 1
    assert jaccard.joined(docs.limit(0)).count() == 0


def test_a_large_block_is_cut_to_sets_that_may_link(spark, monkeypatch):
    line = prose(20, "quoted line")
    rows = [(i, f"{prose(80, i + 7000)}\n{line}") for i in range(60)]
    near = {i: 1000 + i for i in range(0, 60, 6)}
    rows += [(near[i], rows[i][1].replace(" ", " zz ", 1)) for i in near]
    rows += [rows[3], rows[6], rows[6], (None, prose(30, "none")), (2000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ids = jaccard.sized(df, "doc_id", "text", 5)
    blocks = ids.where("n > 0").select(F.col("sid").alias("node"), F.lit(0).cast("long").alias("label")).distinct()
    # Small enough for one task: the block is left as it is.
    assert jaccard.refined(df, ids, blocks, "doc_id", "text", 5, 80).count() == blocks.count()
    monkeypatch.setattr(jaccard, "SETS_PER_CHUNK", 8)
    out = jaccard.refined(df, ids, blocks, "doc_id", "text", 5, 80)
    labels = {r.doc_id: r.label for r in ids.join(out, ids.sid == out.node).collect()}
    assert all(labels[i] == labels[near[i]] for i in near) and len(set(labels.values())) == len(near)
    assert set(labels) == {*near, *near.values()}
    tasks = jaccard.block_texts(df, ids, out, "doc_id", "text").groupBy("sid").count()
    assert tasks.agg(F.max("count")).first()[0] <= 3, "a set goes to one task, as often as its row comes"
    got = {r.doc_id: r.component_id for r in jaccard.joined(df, size=5, percent=80).collect()}
    assert got == {**{i: i for i, _ in rows}, **{j: i for i, j in near.items()}}


@pytest.mark.parametrize("same_id", [None, 7])
def test_texts_under_one_id_meet_only_their_own_sets(spark, same_id):
    base = prose(80, "one id").split()
    rows = [(same_id, " ".join([*base[:k], f"w{k}", *base[k + 1 :]])) for k in range(0, 60, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ids = jaccard.sized(df, "doc_id", "text", 4)
    blocks = ids.select(F.col("sid").alias("node"), F.lit(0).cast("long").alias("label"))
    assert jaccard.block_texts(df, ids, blocks, "doc_id", "text").count() == len(rows)
    kept = jaccard.representatives(df, size=4, percent=80).collect()
    assert len(kept) == 1 and kept[0].doc_id == same_id


# Mixing


def test_targets_stop_at_twice_the_size():
    plan = mixing.Plan()
    assert mixing.targets([100, 100, 100], plan) == pytest.approx([200, 500 / 3, 250 / 3])
    assert mixing.targets([], plan) == [] and mixing.targets([0, 10], plan) == [0.0, 15.0]
    assert sum(mixing.targets([5, 900, 40, 7], plan)) == pytest.approx(1.5 * 952)


def test_takings(spark, docs):
    rows = mixing.Mix(docs).takings().collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["size"] == len(plain_words(r.text)) and 0 <= r.taken <= 2 * r["size"]
    for source in {r.source for r in rows}:
        mine = [r for r in rows if r.source == source]
        assert {r.source_size for r in mine} == {sum(r["size"] for r in mine)}
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 2 * mixing.Plan().block_words
    again = mixing.Mix(docs.repartition(3)).takings().collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    assert mixing.Mix(docs.limit(0)).takings().count() == 0


def test_mixed_documents_hold_what_is_taken(spark, docs):
    mix = mixing.Mix(docs)
    words = sum(len(plain_words(r.text)) for r in mix.documents().collect())
    assert words == sum(r.taken for r in mix.takings().collect())
    uses = mix.slots().groupBy("rank", "block").count().agg(F.max("count")).first()[0]
    assert uses <= 2


def test_mixed_copies_and_nulls_keep_their_texts(spark):
    rows = [(1, "a b c", "x")] * 3 + [(2, "a b c", "x"), (3, None, "x"), (3, "", "x"), (4, "d e", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = mixing.Mix(docs)
    assert Counter((r.doc_id, r.text, r.source) for r in mix.takings().collect()) == Counter(rows)
    mixed = mix.documents().collect()
    assert {(r.doc_id, r.text, r.source) for r in mixed} <= set(rows)
    assert mixing.Mix(docs, carry=["text"]).takings().count() == len(rows)


# Chat


def test_chat_round_trip(spark):
    hard = ["<|im_end|><|im_start|>assistant ok", "a\\p|\\s\\n", "x<", "", "\n\n", "ü" * 3]
    rows = [(c, t, "system" if t == 0 and c % 2 else ("user", "assistant")[t % 2], hard[(c + t) % 6] + " word" * (t * 40)) for c in range(6) for t in range(9)]
    rows += [(-1, 0, "user", hard[0]), (-1, 1, "assistant", hard[0]), (7, 0, None, None), (8, 0, "system", "alone"), (None, None, "role\nx", "t")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    windows = chat.windows(df, budget=chat.Budget(256, 64))
    got = {r.conv_id: r for r in chat.read_back(windows).collect()}
    for c in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == c), key=lambda r: r[1] or 0)
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    shown = windows.where("conv_id = 1").orderBy("window").collect()
    assert len(shown) > 1 and all(w.formatted.startswith("<|im_start|>system\n") for w in shown)
    assert chat.read_back(chat.windows(df.limit(0))).count() == 0


def test_chat_query_runs_no_python(spark, sf_dir):
    for name in ("op3_chat_formatting", "op8_quality_rules"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# Language and toxicity


def test_language_of_odd_rows(spark):
    said = {"en": "the cat and the dog with this house", "de": "der hund und die katze mit dem haus", "fr": "le chien et la maison avec une fille"}
    rows = [(i * 3 + k, f"{t} {i}", lang) for i in range(30) for k, (lang, t) in enumerate(said.items())]
    rows += [(500, None, "en"), (501, "12 !?", "fr"), (502, "und die", None), (None, "x", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fitted(df.where("doc_id < 60"), "text", "lang", F.xxhash64("doc_id"))
    got = {r.doc_id: r for r in language.predicted(df, model).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows if i is not None and i < 90)
    assert got[500].lang_pred == got[501].lang_pred == "und" and got[502].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in got.values())
    doubled = df.where("doc_id < 60")
    again = language.fitted(doubled.unionByName(doubled), "text", "lang", F.xxhash64("doc_id"))
    assert {r.doc_id: r for r in language.predicted(df, again).collect()} == got
    none = language.fitted(df.limit(0), "text", "lang", F.xxhash64("doc_id"))
    assert {r.lang_pred for r in language.predicted(df, none).collect()} == {"und"}


@pytest.fixture(scope="module")
def larger():
    return "/root/testdata/sf0.01"


def test_language_held_out(spark, larger):
    found = QUERIES["op1_language_id"](spark, larger).where("held_out")
    docs = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "lang")
    right = found.join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98


def test_toxicity_held_out(spark, larger):
    found = QUERIES["op4_toxicity"](spark, larger)
    assert found.count() == spark.read.parquet(f"{larger}/documents.parquet").count()
    rows = found.where("held_out").join(spark.read.parquet(f"{larger}/labels.parquet"), "doc_id").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.9


def test_toxicity_of_odd_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fitted(docs, none, F.lit(True)).scores([""]).tolist() == [0.0]
    x, y = toxicity.isotonic(np.array([1.0, 2, 3, 3]), np.array([0.0, 1, 0, 1]))
    assert (np.diff(y) >= 0).all() and x[0] == 1


# Exact search


def test_tree_against_all_scores(spark):
    random_ = np.random.default_rng(1)
    rows = [(i, [float(v) for v in random_.normal(size=8)]) for i in range(600)]
    rows += [(1000 + i, [0.5] * 8) for i in range(300)] + [(2000, None), (2100, []), (2200, [math.nan] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1))
    got = {}
    for r in metric_tree.top_k(df, F.col("vec_id") % 100 == 0, k=5, chunk_rows=200, block_rows=4).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    whole = {i: np.floor(1024 * np.array(v, dtype=np.float32).astype(float)).astype(int) for i, v in rows if i is not None and i < 2000}
    assert set(got) == {i for i in whole if i % 100 == 0}
    for q, found in got.items():
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5]
        assert sorted(found) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert metric_tree.top_k(df.limit(0), F.lit(True)).count() == 0


def test_large_components_and_different_lengths(spark):
    random_ = np.random.default_rng(2)
    vectors = {i: [float(v) for v in random_.uniform(-1, 1, size=1 + i % 5) * 10.0 ** (i % 9 - 2)] for i in range(200)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in vectors.items()}
    got = {}
    for r in metric_tree.top_k(df, F.col("vec_id") % 20 == 0, k=4, chunk_rows=50, block_rows=3).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in range(0, 200, 20):
        score = lambda v: max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(whole[q], v, strict=False))))  # noqa: B023, E731
        best = sorted((-score(v), i) for i, v in whole.items() if i != q)[:4]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]


# Pages


def test_main_text(spark):
    page = (
        "<html><head><title>t</title><style>p{{}}</style></head><body class=home><header>Site</header><nav><ul><li><a href=/>x</a></ul></nav>"
        "<div class='cookie-notice'>We use</div><div id=c class='content post-{i}'><h1>Head &amp;\n line</h1><p>First <b>para</b>, {i} is\there"
        " and long enough.<p>Second &lt;one&gt;<br>more<script>var a='</p>';</script></p><div class='ad'>Buy</div>"
        "<form>Name <input></form></div><div class=comments><p>Nice!</p></div><footer>(c)</footer></body></html>"
    )
    rows = [(i, f"https://h.org/{i}", page.format(i=i)) for i in range(5)] + [(7, None, None), (8, "x", ""), (9, "https://h.org/", "<p>only this")]
    got = {r.page_id: (r.text, r.n_chars) for r in pages.main_text(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    for i in range(5):
        want = f"Head & line\nFirst para, {i} is here and long enough.\nSecond <one> more"
        assert got[i] == (want, len(want))
    assert got[7] == got[8] == ("", 0) and got[9][0] == "only this"


def extracted_pages(spark, htmls):
    rows = spark.createDataFrame([(i, "https://h.org/", h) for i, h in enumerate(htmls)], "page_id int, url string, html string")
    return [r.text for r in pages.main_text(rows).orderBy("page_id").collect()]


NESTED = "<h1>The headline</h1><div class=lead>{lead}</div><div class=body><p>{body}</p></div>"


@pytest.mark.parametrize("before,after", [("<article>", "</article>"), ("<main><div>", "</div></main>"), ("<div class=story>", "</div>")])
def test_headline_and_lead_stay(spark, before, after):
    links = "<ul><li><a href=/a>One other page</a></li><li><a href=/b>Another one</a></li></ul>"
    inner = [NESTED.format(lead=prose(20, ("lead", i)[1]), body=prose(300, i)) for i in range(3)]
    got = extracted_pages(spark, [f"<body>{links}{before}{x}{after}</body>" for x in inner])
    assert got == ["\n".join(("The headline", prose(20, i), prose(300, i))) for i in range(3)]


def test_a_teaser_does_not_stand_for_the_article(spark):
    usual = [f"<body><div class=a><p>{prose(200, i)}</p></div></body>" for i in range(4)]
    rare = f"<body><div class=a><p>A teaser</p></div><ul><li><a href=/>{prose(90, 'x')}</a></ul><section class=b><p>{prose(200, 'rare')}</p></section></body>"
    assert prose(200, "rare") in extracted_pages(spark, [*usual, rare])[4]


@pytest.mark.parametrize(
    "wrapper",
    ["class='content has-sidebar'", "class=no-comments", "class=side-by-side", "id=page-with-menu", "class='page menu'", "class=hasSidebar"],
)
def test_wrappers_are_not_left_out(spark, wrapper):
    side = f"<div class=main-nav><p>Home</p></div><div class='comment-list'><p>{prose(400, 'talk')}</p></div>"
    for tag in ("article", "div"):
        page = f"<body><div {wrapper}><{tag}><h1>Head</h1><p>{prose(100, 1)}</p></{tag}></div>{side}</body>"
        if "page menu" in wrapper and tag == "div":
            page = page.replace(side, "")
        assert extracted_pages(spark, [page]) == [f"Head\n{prose(100, 1)}"]


def test_given_pages_by_their_template(spark, sf_dir):
    from html import unescape

    got = {r.page_id: r.text for r in QUERIES["op6_html_extraction"](spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        parts = (" ".join(unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)>", body))
        assert got[r.page_id] == "\n".join(p for p in parts if p)


# Encoding

PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def test_ids_are_the_library_s(spark, sf_dir):
    import sentencepiece as library

    model, other = sentencepiece.Model.read(PIECES), library.SentencePieceProcessor(model_file=PIECES)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts += ["", " ", "  a  b ", "a▁b", "日本語" * 40, "\0\n\t x", "😀" * 30, "x" * 3000, " " * 100 + "q", "</s><0x41>"]
    ids = model.encode(texts)
    assert ids == other.encode(texts)
    assert [model.decode(i) == t for i, t in zip(ids, texts)] == ["▁" not in t for t in texts]


def test_unigram_takes_the_best_path():
    pieces = ["<unk>", "▁", "a", "b", "ab", "▁a", "ba", "▁ab"]
    scores = [0.0, -3.0, -2.0, -2.0, -3.0, -2.5, -3.5, -6.5]
    model = sentencepiece.Model(pieces, scores, [2, 1, 1, 1, 1, 1, 1, 1], sentencepiece.UNIGRAM)
    assert model.encode(["ab", "aab", "azzb", "a ab", ""]) == [[5, 3], [5, 4], [5, 0, 3], [5, 5, 3], []]


def test_encoded_odd_rows(spark, docs):
    model = sentencepiece.Model.read(PIECES)
    out = sentencepiece.encoded(docs, model)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == docs.select("doc_id").distinct().count()
    assert got[300].ids is None and got[301].ids == [] and got[304].exact
    back = {r.doc_id: r.text for r in sentencepiece.decoded(out, model).collect()}
    assert back == {r.doc_id: r.text for r in docs.collect()}
    assert sentencepiece.encoded(docs.limit(0), model).count() == 0


def test_substrings_move_texts_and_units_once(spark):
    df = spark.createDataFrame([(1, "a" * 60 + ". " + "b" * 60), (2, "b" * 60), (3, None)], "doc_id long, text string")
    out = substrings.deduplicated(df)
    text = out._jdf.queryExecution().executedPlan().toString()
    # The units meet the first of each digest, and the texts what they lose.
    assert text.count("Join") == 2 and "Union" not in text
    assert {r.doc_id: r.text for r in out.collect()} == {1: "a" * 60 + ". " + "b" * 60, 2: "", 3: None}


def test_texts_are_cut_in_one_python_pass(spark, docs):
    plan = substrings.documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_the_mix_starts_no_python_worker(spark, docs):
    mix = mixing.Mix(docs)
    for out in (mix.sources, mix.slots()):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "ExistingRDD" not in plan and "Python" not in plan
    # Few rows by the planner's guess, but a row for each slot.
    plan = mix.mixed()._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[rank#\d+, block#", plan)


def test_hashes_of_one_set_alone_are_not_indexed():
    draws = np.random.default_rng(9)
    unlike = [np.unique(draws.integers(0, 1 << 62, 500, dtype=np.uint64)) for _ in range(400)]
    twins = [np.append(h[1:], np.uint64((1 << 62) + i)) for i, h in enumerate(unlike[:5])]
    sets = [(jaccard.set_id(h), h) for h in unlike + twins]
    tracemalloc.start()
    found = list(jaccard.links(sets, 80))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {frozenset(x) for x in found} == {frozenset((sets[i][0], sets[400 + i][0])) for i in range(5)}
    assert peak < 12 * sum(h.nbytes for _, h in sets)


def test_texts_encoded_in_parts_all_come_back(spark):
    model = sentencepiece.Model.read("/opt/tokenizers/piece_bpe_32k.model")
    texts = [prose(300, i) for i in range(1000)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    rows = sentencepiece.encoded(df, model).select("ids", "exact").collect()
    assert [r.ids for r in rows] == model.encode(texts) and all(r.exact for r in rows)
