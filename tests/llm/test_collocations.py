"""Collocations against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

from tablecheck.llm import collocations


def counted(rows, most):
    """lang -> rows (rank, phrase, a, l, r, n, score) by counting every phrase."""
    result = []
    for lang in {r[0] or "und" for r in rows}:
        found = Counter()
        for own, text in rows:
            if (own or "und") != lang or not text:
                continue
            lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            for piece in re.split("[.,;:!?\n-\r]", lowered):
                words = [w for w in re.split("[ \t]+", piece) if w]
                for size in (1, 2, 3):
                    found.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
        n = sum(c for p, c in found.items() if len(p) == 1)
        often = {p: c for p, c in found.items() if len(p) > 1 and c >= 10}
        kept = []
        for phrase, a in often.items():
            longer = [c for p, c in often.items() if len(p) == 3 and phrase in (p[:2], p[1:])]
            if any(100 * c >= 50 * a for c in longer):
                continue
            cuts = [(found[phrase[:k]], found[phrase[k:]], k) for k in range(1, len(phrase))]
            score, _, left, right = min((10**6 * a * a // (x * y), k, x, y) for x, y, k in cuts)
            kept.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:most], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(result)


def some_texts(draw, count):
    syllables = ["ka", "lo", "mi", "ra", "ÉT", "a|", "b c", "\x1c"]
    words = ["".join(draw.choices(syllables, k=2)) for _ in range(25)]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]
    langs = ["en", "en", "en", "de", None]
    rows = []
    for _ in range(count):
        text = "".join(draw.choice(words) + draw.choice(ends) for _ in range(60))
        rows.append((draw.choice(langs), text + "New YORK city hall " * draw.randrange(3)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def test_like_plain_counting(spark):
    rows = some_texts(random.Random(2), 150) + [("en", None), (None, ""), ("fr", "un mot")]
    found = collocations.mine(frame(spark, rows), "lang", "text").collect()
    assert sorted(map(tuple, found)) == counted(rows, 2000)


def test_frontier_grows_until_the_wanted_rank_is_settled(spark, monkeypatch):
    rows = some_texts(random.Random(7), 150)
    # nearly all of the best pairs are dropped inside longer phrases, so one round is too few
    rows += [("en", f"one{k} two{k} three{k}. ") for k in range(12) for _ in range(12)]
    rounds = []
    expanded = collocations._expanded

    def noted(texts, pairs, words, threshold):
        rounds.append({r.lang: r.threshold for r in threshold.collect()})
        return expanded(texts, pairs, words, threshold)

    monkeypatch.setattr(collocations, "_expanded", noted)
    monkeypatch.setattr(collocations, "AHEAD", 1)
    found = collocations.mine(frame(spark, rows), "lang", "text", most=20).collect()
    assert sorted(map(tuple, found)) == counted(rows, 20)
    assert len(rounds) > 1 and rounds[1]["en"] < rounds[0]["en"]


def test_ties_at_the_last_rank_and_small_maps(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SLOTS", 2**15)
    monkeypatch.setattr(collocations, "CHUNK", 100)
    rows = [("en", f"tie{k} end{k}") for k in range(40) for _ in range(11)]
    found = collocations.mine(frame(spark, rows), "lang", "text", most=7).collect()
    assert sorted(map(tuple, found)) == counted(rows, 7)


def test_odd_tables(spark, odd_documents, no_documents):
    rows = [(r.lang, r.text) for r in odd_documents.collect()]
    found = collocations.mine(odd_documents, "lang", "text").collect()
    assert sorted(map(tuple, found)) == counted(rows, 2000)
    assert collocations.mine(no_documents, "lang", "text").count() == 0
