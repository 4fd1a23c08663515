"""Chosen-path near-duplicates, collocations and tokenizer alignment against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import alignment, chosen_path, collocations
from tidemark.llm.queries import BYTE_BPE, PIECES

rng = random.Random(11)
WORDS = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(300)]


# Near-duplicates


def shingles(text, size):
    words = [w.decode() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())]
    return frozenset([tuple(words)] if 0 < len(words) < size else [tuple(words[k : k + size]) for k in range(len(words) - size + 1)])


def near_rows():
    """Groups of edited copies, some large and loose, around a passage that many share."""
    passage = rng.choices(WORDS, k=12)
    rows = []
    for group, (size, edits) in enumerate([(1, 0), (3, 1), (40, 2), (60, 5), (25, 9), (2, 3), (30, 0)]):
        base = rng.choices(WORDS, k=rng.choice([60, 90])) + passage
        for copy in range(size):
            words = list(base)
            for k in random.Random(group * 100 + copy).sample(range(len(words)), edits):
                words[k] = f"x{copy}"
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows) + i, " ".join(rng.choices(WORDS, k=40) + passage)) for i in range(60)]
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE\ttwo"), (905, "one two three"), (905, "one two three")]


def components(rows, size, percent):
    sets = [(i, shingles(t, size)) for i, t in rows]
    label = list(range(len(sets)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i][1] & sets[j][1])
            if both and 100 * both >= percent * (len(sets[i][1]) + len(sets[j][1]) - both):
                label[max(find(i), find(j))] = min(find(i), find(j))
    out = Counter()
    for i, (doc, s) in enumerate(sets):
        first = min(sets[j][0] for j in range(len(sets)) if find(j) == find(i))
        out[doc, len(s), first, doc == first] += 1
    return out


@pytest.mark.parametrize("bounds", [None, (8, 10, 6, 3), (5, 400, 30, 2)])
@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates_by_brute_force(spark, monkeypatch, size, percent, bounds):
    """With the bounds as they are, and so low that nodes are split, dealt in blocks and met by pivots."""
    if bounds:
        for name, value in zip(("NODE", "FEW", "BLOCK", "LEVELS"), bounds, strict=True):
            monkeypatch.setattr(chosen_path, name, value)
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"node": F.lit(1), "sid": F.lit("x"), "n": F.lit(0)})
    got = chosen_path.near_duplicates(docs.repartition(5), size=size, percent=percent).collect()
    assert Counter(tuple(r) for r in got) == components(rows, size, percent)


def test_near_duplicates_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    out = chosen_path.near_duplicates(empty)
    assert out.collect() == [] and out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    nulls = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (5, "q " * 50_000), (None, None)], "doc_id long, text string")
    got = Counter(tuple(r) for r in chosen_path.near_duplicates(nulls).collect())
    assert got == Counter([(None, 2, None, True), (None, 2, None, True), (5, 1, 5, True), (None, 0, None, True)])


def test_recall_target():
    assert chosen_path.trees_for(85, 0.9) == 1
    assert chosen_path.trees_for(85, 0.99999) == 4 and chosen_path.trees_for(80, 0.99999) > 4


# Collocations


def phrases(rows, least, subsumed, top):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        f = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            totals[lang] += len(words)
            for n in (1, 2, 3):
                f.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if longer and 100 * max(longer) >= subsumed * a:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def test_collocations_by_brute_force(spark):
    pool = [*WORDS[:25], "New", "YORK", "é", "Straße", "x" * 300]
    rows = []
    for i in range(120):
        words = [pool[int(rng.random() ** 2 * len(pool))] for _ in range(60)]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ", ", "\n", "!?", " \x0b"]) for w in words)
        rows.append((rng.choice(["en", "en", "de", None]), text + "new york city " * rng.randint(0, 2)))
    rows += [("en", rows[0][1])] * 15 + [("fr", None), ("fr", ""), ("it", "solo"), (None, ". . .")]
    docs = spark.createDataFrame(rows, "lang string, text string").withColumns({"n": F.lit("x"), "word": F.lit(1), "p1": F.lit(2)})
    for least, subsumed, top in ((10, 50, 2000), (3, 80, 20)):
        got = collocations.collocations(docs.repartition(4), least=least, subsumed=subsumed, top=top).collect()
        assert sorted(map(tuple, got)) == phrases(rows, least, subsumed, top)
    assert collocations.collocations(docs.limit(0)).collect() == []


def test_a_clash_of_hashes_takes_the_next_seed(spark, monkeypatch):
    seeds = []
    plain = collocations.counted_words

    def counted(rows, seed):
        seeds.append(seed)
        return plain(rows, seed).withColumn("clash", F.lit(seed < 2))

    monkeypatch.setattr(collocations, "counted_words", counted)
    docs = spark.createDataFrame([("en", "a b " * 12)], "lang string, text string")
    got = [r.phrase for r in collocations.collocations(docs).collect()]
    assert seeds == [0, 1, 2] and "a b" in got or "a b a" in got


# Alignment

ODD = [
    "  two  blanks", "a\n b", "a \n  b  ", " lead", "x ", "\n", "▁mark", " ", "it's  <|endoftext|> ok</s><s>", "日本語 の文字 🎉👍🏽", "a  b　 c",
    "tab\t tab \t x", "é" * 600 + " " + "ab" * 700, "\x1c \x1f a", "a\x00b", "", None, "the the the " * 50, "é é", "\r\n\r\n  z", " \n \n ", "a   \n\n   b",
]


def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    both = alignment.Tokenizers.read(BYTE_BPE, PIECES)
    a_library, b_library = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_library.encode_special_tokens = True
    found, count = [], Counter()
    for doc, text in rows:
        a = a_library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_library.encode(text) if text else []
        want = (" " + (text or "")).encode()
        if not text or b"".join(both.bytes_a[i] for i in a) != want or b"".join(both.bytes_b[i] for i in b) != want:
            found.append((doc, None))
            continue
        ends = [[0], [0]]
        for side, ids, table in ((0, a, both.bytes_a), (1, b, both.bytes_b)):
            for i in ids:
                ends[side].append(ends[side][-1] + len(table[i]))
        links, groups, i, j, first = [], [], 0, 0, (0, 0)
        while i < len(a):
            links.append((a[i], b[j]))
            x, y = ends[0][i + 1], ends[1][j + 1]
            i, j = i + (x <= y), j + (y <= x)
            if x == y:
                groups.append("|".join(",".join(map(str, ids[k:m])) for ids, k, m in ((a, first[0], i), (b, first[1], j))))
                first = (i, j)
        count.update(links)
        found.append((doc, (len(a), len(b), groups, links)))
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    for doc, x in found:
        if x is None:
            yield doc, 0, 0, 0, 0, 0, 0, ""
        else:
            n_best = sum(count[link] == best[link[1]] for link in x[3])
            digest = hashlib.sha256(";".join(x[2]).encode()).hexdigest()
            yield doc, x[0], x[1], len(x[2]), len(x[3]), n_best, sum(count[link] for link in x[3]), digest


def test_alignment_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(80)
    rows = [tuple(r) for r in docs.collect()] + [(100_000 + i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (100_000, ODD[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"chunk": F.lit("c"), "whole": F.lit(1), "n_a": F.lit("clash")})
    out = alignment.aligned(df.repartition(6), alignment.Tokenizers.read(BYTE_BPE, PIECES))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r[n] for n in names) for r in out.collect()) == Counter(brute_alignment(rows))
    assert set(out.columns) == {*names, "text", "chunk", "whole"}
    assert alignment.aligned(df.limit(0), alignment.Tokenizers.read(BYTE_BPE, PIECES)).count() == 0


def test_units_join_to_the_text():
    both = alignment.Tokenizers.read(BYTE_BPE, PIECES)
    for text in ODD:
        if text:
            assert "".join(" " + u for u in both.units(text)) == " " + text
    # Sent to a worker, the tokenizers are the files' content only.
    import pickle

    assert pickle.loads(pickle.dumps(both)).a == both.a
