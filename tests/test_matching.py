import random
import re

import pytest
from pyspark.sql import functions as F

from evidentia.operators import matching as K

WORDS = "energy use of the site water scope emission emissions total renewable share waste a in co2 hazardous rate energie dechet für 漢字 ratio".split()


def plain_common(a, b):
    """The longest common subsequence by the textbook table."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def plain_ratio(a, b, common=plain_common):
    return 200.0 * common(a, b) / (len(a) + len(b)) if a or b else 100.0


def plain_partial(a, b, common=plain_common):
    if not a or not b:
        return 0.0 if a or b else 100.0
    if len(a) > len(b):
        a, b = b, a
    n = len(a)
    best = max(plain_ratio(a, b[max(0, s) : s + n], common) for s in range(1 - n, len(b)))
    return max(best, max(plain_ratio(b, a[max(0, s) : s + n], common) for s in range(1 - n, n))) if len(b) == n else best


def plain_weighted(a, b, common=plain_common):
    """The weighted ratio as its definition reads."""
    if not a or not b:
        return 0.0
    x, y = a.split(), b.split()
    one, two = set(x), set(y)
    both, d1, d2 = sorted(one & two), " ".join(sorted(one - two)), " ".join(sorted(two - one))
    s1, s2 = " ".join(sorted(x)), " ".join(sorted(y))
    best, sizes = plain_ratio(a, b, common), max(len(a), len(b)) / min(len(a), len(b))
    if sizes < 1.5:
        if not x or not y:
            of_sets = 0.0
        elif both and (not d1 or not d2):
            of_sets = 100.0
        else:
            front = " ".join(both)
            full = [" ".join(filter(None, (front, d))) for d in (d1, d2)]
            # the common front is aligned with itself
            edits = len(d1) + len(d2) - 2 * common(d1, d2)
            of_sets = 100.0 * (1 - edits / (len(full[0]) + len(full[1])))
            if both:
                of_sets = max(of_sets, *(200.0 * len(front) / (len(front) + len(f)) for f in full))
        return max(best, 0.95 * max(plain_ratio(s1, s2, common), of_sets))
    scale = 0.9 if sizes <= 8 else 0.6
    tokens = 100.0 if both else max(plain_partial(s1, s2, common), plain_partial(d1, d2, common) if (len(one) < len(x) or len(two) < len(y)) else 0.0)
    return max(best, scale * plain_partial(a, b, common), 0.95 * scale * tokens)


def plain_longest(line, keywords):
    """The longest keyword that stands in a line as whole words, the first place on a tie."""
    hits = [(-len(k), m.start(), k) for k in keywords for m in re.finditer(rf"(?<![A-Za-z0-9_])(?={re.escape(k)}(?![A-Za-z0-9_]))", line)]
    return min(hits)[2] if hits else None


def plain_best(line, index):
    """(keyword, likeness) by trying every metric and keyword in order."""
    metrics = {}
    for k, (m, *_) in index.items():
        metrics.setdefault(m, []).append(k)
    best = None
    for ks in metrics.values():
        anchors = {w for k in ks for w in k.split() if len(w) >= 4}
        if len(line) < 12 or len(anchors & set(line.split())) < min(2, len(anchors)):
            continue
        for k in ks:
            if len(k) >= 8 and (s := plain_weighted(line, k, K.common_length)) > max(82.0, best[1] if best else 0.0):
                best = (k, s)
    return best


def noisy(r, n):
    words = [r.choice(WORDS) for _ in range(n)]
    text = " ".join(words)
    for _ in range(r.randrange(4)):
        i = r.randrange(len(text) + 1)
        text = text[:i] + r.choice(["", "x", " ", "e"]) + text[i + r.randrange(2) :]
    return " ".join(text.split())


def test_common_subsequence_by_bits():
    r = random.Random(1)
    for _ in range(500):
        a, b = ("".join(r.choice("abcé 漢") for _ in range(r.randrange(90))) for _ in range(2))
        assert K.common_length(a, b) == plain_common(a, b)


def test_weighted_ratio_equals_its_definition():
    r = random.Random(2)
    pairs = [(noisy(r, r.randrange(1, 7)), noisy(r, r.randrange(1, 4))) for _ in range(600)]
    pairs += [("", "a"), ("", ""), ("a b", "b a"), ("abc", "abc"), ("x", "abcdefgh x"), (" ", "ab"), ("total waste", "total waste total"), ("k" * 70, "k" * 69 + "m" * 200), ("abcd", "dcba"), ("abcd efgh", "efgx abcx zz yy xx ww vv uu tt")]
    assert list(K.weighted_ratios(pairs)) == pytest.approx([plain_weighted(a, b) for a, b in pairs], abs=1e-9)


def test_weighted_ratio_of_ten_thousand_pairs():
    r = random.Random(3)
    keywords = [noisy(r, r.randrange(1, 5)) for _ in range(60)]
    pairs = [(noisy(r, r.randrange(2, 22)), r.choice(keywords)) for _ in range(10_000)]
    got = K.weighted_ratios(pairs)
    want = [plain_weighted(a, b, K.common_length) for a, b in pairs]
    assert list(got) == pytest.approx(want, abs=1e-9)
    assert ((got > 82) == [w > 82 for w in want]).all() and 0 < (got > 82).sum() < len(pairs)


def test_longest_keyword_hidden_by_an_earlier_one(spark):
    line = "use scope energy use of the site"
    df = spark.createDataFrame([(line,), (None,), ("",), ("reuse scopes",)], "t string")
    keywords = ["use scope", "scope energy use of the site"]
    assert [x.k for x in df.select(K.longest_keyword(F.col("t"), keywords).alias("k")).collect()] == [keywords[1], None, None, None]
    assert df.select(K.longest_keyword(F.col("t"), keywords, overlapping=False).alias("k")).first().k == keywords[0]


@pytest.mark.parametrize("part_bytes", [12, 1 << 20])
def test_automaton_equals_a_loop(spark, part_bytes):
    r = random.Random(5)
    keywords = list(dict.fromkeys(noisy(r, r.randrange(1, 4)) for _ in range(60)))
    lines = [noisy(r, r.randrange(0, 12)) if r.random() < 0.9 else "_".join(r.choices(WORDS, k=4)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, t string")
    got = {x.i: x.k for x in df.select("i", K.longest_keyword(F.col("t"), keywords, part_bytes=part_bytes).alias("k")).collect()}
    assert got == {i: plain_longest(t, [k for k in keywords if k]) for i, t in enumerate(lines)}


def test_a_hundred_thousand_keywords_in_one_pass(spark):
    r = random.Random(6)
    words = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(2_000)]
    keywords = list(dict.fromkeys(" ".join(r.choices(words, k=r.randrange(1, 4))) for _ in range(100_000)))
    lines = [" ".join(r.choices(words, k=20)) for _ in range(400)]
    known = set(keywords)

    def loop(line):
        w = line.split()
        spans = [(-len(" ".join(w[i:j])), i, " ".join(w[i:j])) for i in range(len(w)) for j in range(i + 1, min(len(w), i + 3) + 1) if " ".join(w[i:j]) in known]
        return min(spans)[2] if spans else None

    df = spark.createDataFrame(list(enumerate(lines)), "i int, t string")
    plan = df.select("i", K.longest_keyword(F.col("t"), keywords).alias("k"))
    assert {x.i: x.k for x in plan.collect()} == {i: loop(t) for i, t in enumerate(lines)}


def test_loose_keyword_equals_a_loop(spark):
    r = random.Random(7)
    index = {noisy(r, r.randrange(1, 5)): (f"m{i % 9}", "label", "t") for i in range(40)} | {"ab cd ef": ("short", "l", "u")}
    lines = [noisy(r, r.randrange(1, 14)) for _ in range(400)] + ["", None, "ab cd ef gh ij", "fournisseurs", "clients et fournisseurs"]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, t string")
    got = {x.i: x.k and (x.k.word, x.k.likeness) for x in df.select("i", K.loose_keyword(F.col("t"), index).alias("k")).collect()}
    want = {i: (b := t and plain_best(t, index)) and (b[0], round(b[1], 4)) or None for i, t in enumerate(lines)}
    assert got == want and any(want.values())


def test_lines_that_share_generic_words_only_do_not_match():
    """A metric is asked only if the line has two of its own anchors, so a generic word names none."""
    index = {"dechets dangereux produits": ("hazardous_waste", "l", "t"), "dechets dangereux fournisseurs": ("hazardous_waste", "l", "t"), "audits des fournisseurs": ("supply_chain_audits", "l", ""), "ratio de remuneration du dirigeant": ("ceo_pay_ratio", "l", "")}
    loose = K.Loose(index)
    lines = ["transition energetique indispensable pour demain", "notre strategie durable creer de la valeur", "fournisseurs", "clients et fournisseurs", "dechets dangereux produits sur site"]
    assert [b and index[b[0]][0] for b in loose.best(lines)] == [None, None, None, None, "hazardous_waste"]
