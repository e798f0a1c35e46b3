import random
import re
from collections import Counter, defaultdict

import pytest

from landloom.llm.source_audit import source_divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "lang string, source string, text string, term int, value string"


def plain(rows, least, top):
    """Every kept term of every group, one by one."""
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        g = (lang or "", source or "")
        terms = TERM.findall((text or "").translate(LOWER))
        groups.add(g)
        n[g].update(terms)
        docs[g[0]].update(set(terms))
    out = []
    for lang, source in sorted(groups):
        kept = [t for t, k in docs[lang].items() if k >= least]
        others = sorted(s for g, s in groups if g == lang)
        whole = Counter()
        for s in others:
            whole.update(n[lang, s])

        def share(counts):
            total = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // total for t in kept}
        p, q = share(n[lang, source]), share(whole)
        pairs = [(s, sum(abs(p[t] - x) for t, x in share(n[lang, s]).items())) for s in others if s != source]
        terms = [(t, p[t] - q[t]) for t in kept if n[lang, source][t] and p[t] > q[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, i, v, k) for k, (i, v) in enumerate(ranked, 1)]
    return sorted(out)


def rows():
    draw = random.Random(5)
    common = ["the", "The", "Äpfel", "äpfel", "über", "東京", "it", "s"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(180)]
    out = []
    for k in range(260):
        lang = draw.choice(["de", "de", "en", None, ""])
        source = draw.choice(["hot", "hot", "hot", "a", "b", "c", None, "ÿ", "z"])
        words = [draw.choice(common[: 20 if draw.random() < .5 else len(common)]) for _ in range(draw.randint(0, 80))]
        out.append((lang, source, draw.choice([" ", "1", "-", "\n"]).join(words)))
    out += [("de", "hot", "the " * 4000)] + [("en", "copies", "the same words it")] * 40
    return out + [("fr", "x", "nothing kept"), ("fr", "y", None), ("fr", "z", ""), ("lone", "s", "one " * 40), ("de", "empty", None), (None, None, None)]


@pytest.mark.parametrize("least, top, meeting", [(10, 50, 256), (3, 4, 2), (1, 1000, 3), (10**6, 5, 256)])
def test_against_plain_version(spark, least, top, meeting):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows()], SCHEMA)
    got = [tuple(r) for r in source_divergence(docs, least, top, meeting).collect()]
    assert sorted(got) == plain(rows(), least, top)


def test_empty_table(spark):
    assert source_divergence(spark.createDataFrame([], SCHEMA)).collect() == []


def test_very_long_text(spark):
    text = " ".join(f"t{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}" for k in range(700_000))
    long_ = [("en", "s", text), ("en", "t", text[: len(text) // 2]), ("en", "t", "x" * 3_000_000)]
    got = source_divergence(spark.createDataFrame([(*r, 1, "") for r in long_], SCHEMA), 2).collect()
    assert sorted(map(tuple, got)) == plain(long_, 2, 50)
