"""Collocations against a plain count of all phrases."""

from collections import Counter
import random
import re

import pytest

from tests.llm.conftest import LONG
from treeflat.llm import collocations as co


def brute(rows, max_words=3, least=10, share=50, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, max_words + 1) for i in range(len(words) - k + 1))
    candidates = {k: c for k, c in f.items() if len(k[1]) > 1 and c >= least}
    gone = set()
    for (lang, w), c in candidates.items():
        gone |= {(lang, w[i : i + k]) for k in range(2, len(w)) for i in range(len(w) - k + 1) if 100 * c >= share * f[lang, w[i : i + k]]}
    out = []
    for lang in n:
        own = []
        for (at, w), a in candidates.items():
            if at == lang and (at, w) not in gone:
                cuts = [(10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
                score, k = min(cuts)
                own.append((-score, -a, b" ".join(w), f[lang, w[:k]], f[lang, w[k:]]))
        out += [(lang, rank + 1, p.decode(), -a, left, right, n[lang], -s) for rank, (s, a, p, left, right) in enumerate(sorted(own)[:top])]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, 3, "x") for r in rows], "doc_id long, text string, lang string, n int, phrase string")


def random_rows(seed, count=160):
    draw = random.Random(seed)
    words = ["Of", "of", "the", "é", "日本", "\x00", "a b", " ", "x" * 40, "Éa", "end", "to", "be"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "!? ", " ; ", "\x0b"]
    text = lambda k: "".join(draw.choice(words) + draw.choice(gaps) for _ in range(k))
    rows = [(k, text(draw.randint(0, 40)), draw.choice([None, "en", "en", "en", "und", "fr"])) for k in range(count)]
    copy = text(30)
    return rows + [(1000 + k, copy, "en") for k in range(40)] + [(None, copy, "fr"), (None, None, None), (5, None, "en"), (6, "", "xx"), (7, " . ", "yy"), (3, copy, "fr"), (3, copy, "fr"), (9, LONG + " of the end " * 30, "en")]


@pytest.mark.parametrize("max_words,least,share,top", [(3, 10, 50, 2000), (2, 3, 50, 7), (4, 5, 80, 40)])
def test_collocations(spark, max_words, least, share, top):
    rows = random_rows(max_words)
    got = co.collocations(table(spark, rows).repartition(3), max_words=max_words, least=least, share=share, top=top)
    want = brute(rows, max_words, least, share, top)
    assert len(want) > 10 and sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("bits", [4, 8, 64])
def test_collisions_long_texts_and_small_buffers(spark, monkeypatch, bits):
    """Fingerprints of few bits collide all the time; the results stay."""
    monkeypatch.setattr(co, "FINGERPRINT_BITS", bits)
    monkeypatch.setattr(co, "PIECE", 200)
    monkeypatch.setattr(co, "BUFFER_ROWS", 100)
    monkeypatch.setattr(co, "MAX_FILTER_BYTES", 4096)
    rows = [r for r in random_rows(9, 80) if r[0] != 9] + [(9, "of the end, " * 200 + "to be " * 200 + "y" * 1500 + " of the", "en")]
    got = co.collocations(table(spark, rows).repartition(2))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_nothing(spark):
    got = co.collocations(table(spark, random_rows(1)).limit(0))
    assert got.count() == 0 and got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert co.collocations(table(spark, [(1, "a b", "en"), (2, None, "en")])).count() == 0
