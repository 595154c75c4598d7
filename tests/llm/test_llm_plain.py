"""Operators that SQL cannot express, against the same methods written plainly."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import exact_dedup, language_id, quality, secret_scan
from feedlake.llm.queries import QUERIES


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- language ----------------------------------------------------------------------------


def plain_language(lessons, sizes):
    """Counts of words and n-grams by plain loops; gives the scorer of a text."""
    langs, settings = sorted(sizes), language_id.Settings()
    counts = defaultdict(lambda: defaultdict(Counter))  # order, language
    for lang, text in lessons:
        for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
            if not any(c.isalpha() for c in word):
                continue
            counts[0][lang][word] += 1
            padded = f"^{word}$"
            for order in settings.orders:
                for i in range(len(padded) - order + 1):
                    counts[order][lang][padded[i : i + order]] += 1
    known, kinds, total = {}, {}, {}
    for order, by_lang in counts.items():
        total[order] = {lang: sum(by_lang[lang].values()) for lang in langs}
        kinds[order] = max(len(by_lang[lang]) for lang in langs)
        known[order] = {g for lang in langs for g in by_lang[lang]}

    def logs(order, gram):
        s = settings.smoothing
        return [math.log((counts[order][lang][gram] + s) / (total[order][lang] + s * kinds[order])) for lang in langs]

    def score(word):
        if word in known[0]:
            return logs(0, word)
        padded = f"^{word}$"
        for order in settings.orders:
            found = [logs(order, g) for i in range(len(padded) - order + 1) if (g := padded[i : i + order]) in known[order]]
            if found:
                return [sum(column) / len(found) for column in zip(*found, strict=True)]
        return [0.0] * len(langs)

    def predict(text):
        words = [w for w in re.findall(r"[^\W\d_]+", (text or "").lower()) if any(c.isalpha() for c in w)]
        if not words:
            return "und", 0.0
        sums = [math.log(sizes[lang] / sum(sizes.values())) for lang in langs]
        for word, n in Counter(words).items():
            sums = [a + n * b for a, b in zip(sums, score(word), strict=True)]
        odds = [math.exp(s - max(sums)) for s in sums]
        return langs[odds.index(max(odds))], max(odds) / sum(odds)

    return predict


def test_languages_equal_a_plain_model(spark, sf):
    docs = table(spark, sf, "documents")
    lessons = docs.filter("crc32(cast(cast(doc_id AS string) AS binary)) % 4 <> 2 AND lang IS NOT NULL AND text IS NOT NULL").select("lang", "text").collect()
    sizes = Counter(r.lang for r in lessons)
    assert max(sizes.values()) <= language_id.Settings().sample_rows  # so the sample is all of them
    predict = plain_language([tuple(r) for r in lessons], sizes)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in QUERIES["op1_language_id"](spark, sf).collect():
        lang, score = predict(texts[r.doc_id])
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-9), r.doc_id


def test_a_model_of_any_size_is_not_sent(spark):
    df = spark.createDataFrame([("en", "some words"), ("de", "ein paar Worte")], "lang string, text string")
    with pytest.raises(ValueError, match="cells"):
        language_id.fit(df, settings=language_id.Settings(most_cells=20))


# --- quality -----------------------------------------------------------------------------

MASK = (1 << 64) - 1


def plain_features(text, settings):
    """The hashed n-grams of a text, one after the other."""
    raw, out = (text or "").encode(), set()
    mixed = []
    for at in range(len(raw)):
        rolled = 0
        for n in range(1, settings.orders + 1):
            if at + n > len(raw):
                break
            rolled = (rolled * 0x9E3779B97F4A7C15 + raw[at + n - 1] + n) & MASK
            mixed.append(rolled)
    words = raw.split()
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    if same:
        mixed.append((1 << 40) + int(math.log2(same / len(words)) - 1))
    for x in mixed:
        x ^= x >> 29
        out.add((x * 0xBF58476D1CE4E5B9 & MASK) >> (64 - settings.bits))
    return sorted(out)


def labelled(n=160, seed=5):
    draw, rows = random.Random(seed), []
    for i in range(n):
        good = i % 3 > 0
        words = ["".join(draw.choice("abcdefgh" if good else "efghijkl") for _ in range(draw.randint(2, 6))) for _ in range(draw.randint(1, 40))]
        rows.append((" ".join(words + words[-1:] * draw.randint(0, 2)), good))
    return rows


def test_quality_ratios_equal_plain_ones():
    settings = quality.Settings(bits=14)
    rows = labelled()
    found = [quality.features(t, settings) for t, _ in rows]
    for (text, _), f in zip(rows, found, strict=True):
        assert list(f) == plain_features(text, settings)
    good = np.array([g for _, g in rows])
    ratios = quality.log_count_ratios(found, good, 1 << settings.bits)
    size = 1 << settings.bits
    counts = {side: Counter(x for f, g in zip(found, good, strict=True) if g == side for x in f) for side in (True, False)}
    sums = {side: size + sum(c.values()) for side, c in counts.items()}
    for x in {x for f in found for x in f} | {0, 1, size - 1}:
        plain = math.log((counts[True][x] + 1) / sums[True]) - math.log((counts[False][x] + 1) / sums[False])
        assert ratios[x] == pytest.approx(plain, abs=1e-12)


def test_quality_weights_equal_those_of_another_solver():
    """The same problem by accelerated projected gradients over its dual; and the gap between primal and dual is small."""
    settings = quality.Settings(bits=12, passes=400, cost=0.5)
    rows = labelled()
    found = [quality.features(t, settings) for t, _ in rows]
    good = np.array([g for _, g in rows])
    size = 1 << settings.bits
    ratios = quality.log_count_ratios(found, good, size)
    scaled = [quality.scale(f, ratios) for f in found]
    side = np.where(good, 1.0, -1.0)
    weights = quality.dual_descent(found, scaled, side, size, settings)
    x = np.zeros((len(rows), size + 1))
    for i, (f, v) in enumerate(zip(found, scaled, strict=True)):
        x[i, f], x[i, size] = v, 1
    signed = x * side[:, None]
    gram = signed @ signed.T
    step = 1 / np.linalg.eigvalsh(gram)[-1]
    support = ahead = np.zeros(len(rows))
    momentum = 1.0
    for _ in range(60_000):
        after = np.clip(ahead - step * (gram @ ahead - 1), 0, settings.cost)
        grown = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        ahead = after + (momentum - 1) / grown * (after - support)
        support, momentum = after, grown
    primal = lambda w: w @ w / 2 + settings.cost * np.maximum(0, 1 - signed @ w).sum()
    dual = support.sum() - support @ gram @ support / 2
    assert primal(signed.T @ support) - dual <= 1e-6 * dual
    assert primal(weights) - dual <= 1e-3 * dual
    assert np.abs(weights - signed.T @ support).max() <= 2e-2 * np.abs(weights).max()


def test_quality_scores_equal_plain_ones(spark, sf):
    """Every text scored by hand with the weights of the fit; rows that occur again and clashing columns of labels change nothing."""
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels").filter("crc32(cast(cast(doc_id AS string) AS binary)) % 5 <> 0")
    model = quality.fit(docs, labels)
    clash = quality.fit(docs.withColumn("label", F.lit(1)).withColumn("rank", F.lit(2)), labels.withColumns({"text": F.lit("x"), "lang": F.lit("y"), "label": F.lit(0)}))
    assert np.array_equal(model.weights, clash.weights) and (model.bias, model.slope, model.offset) == (clash.bias, clash.slope, clash.offset)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in QUERIES["op7_quality"](spark, sf).collect():
        found = plain_features((texts[r.doc_id] or "")[:3_000], model.settings) if len(texts[r.doc_id] or "") <= 3_000 else quality.features(texts[r.doc_id], model.settings)
        margin = sum(model.weights[x] for x in found) / math.sqrt(max(1, len(found))) + model.bias
        assert r.score == pytest.approx(1 / (1 + math.exp(-min(30, max(-30, model.slope * margin + model.offset)))), abs=1e-9)


def test_rows_that_occur_again_weigh_more(spark):
    """Each pair of a document and a label of its id is a lesson; the fit is the same wherever the rows lie."""
    rows = [(i, t, int(g)) for i, (t, g) in enumerate(labelled())]
    docs = spark.createDataFrame([r[:2] for r in rows + rows[:20]] + [(None, "x"), (900, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows + rows[:10]] + [(None, 1), (901, 0), (3, None), (4, 7)], "doc_id long, quality int")
    one, two = quality.fit(docs, labels), quality.fit(docs.repartition(5), labels.repartition(3))
    assert np.array_equal(one.weights, two.weights) and one.bias == two.bias
    lessons = docs.join(labels.filter("quality IN (0, 1)"), "doc_id")
    assert lessons.count() == len(rows) + 20 + 2 * 10


# --- secrets -----------------------------------------------------------------------------

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALNUM = set(DIGITS + LOWER + UPPER)


def run(text, at, allowed):
    end = at
    while end < len(text) and text[end] in allowed:
        end += 1
    return end


def pem_mark(text, at, word):
    """The end of a BEGIN or END line at ``at``, or None."""
    start = f"-----{word} "
    if not text.startswith(start, at):
        return None
    at += len(start)
    kind = run(text, at, set(UPPER))
    for place in ((kind + 1, at) if kind > at and text.startswith(" ", kind) else (at,)):
        if text.startswith("PRIVATE KEY-----", place):
            return place + len("PRIVATE KEY-----")
    return None


def match_at(kind, text, at):
    """The end of a match that begins here and whether it counts, by reading on character by character."""
    if kind == "assign":
        for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            here = text[at : at + len(word)]
            if here.isascii() and here.lower() == word:
                end = at + len(word)
                end += text[end : end + 1] in ("'", '"')
                end = run(text, end, " ")
                if text[end : end + 1] not in (":", "="):
                    continue
                end = run(text, end + 1, " ")
                end += text[end : end + 1] in ("'", '"')
                last = run(text, end, ALNUM | set("+/_.=-"))
                if last > end:
                    return last, last - end >= 8
        return None
    if kind == "access":
        last = run(text, at + 4, set(UPPER + DIGITS)) if text.startswith("AKIA", at) else at
        return (last, last - at >= 16) if last > at + 4 else None
    if kind == "hex":
        last = run(text, at, set(DIGITS + "abcdef"))
        return (last, last - at >= 32) if last > at else None
    if kind == "pem":
        body = pem_mark(text, at, "BEGIN")
        end = body and run(text, body, ALNUM | set("+/=") | {c for c in text if c.isspace()})
        last = pem_mark(text, end, "END") if end and end > body else None
        return (last, True) if last else None
    if kind == "jwt":
        end = at
        for i, dot in enumerate((".", ".", "")):
            if i < 2 and not text.startswith("eyJ", end):
                return None
            start = end + (3 if i < 2 else 0)
            end = run(text, start, ALNUM | set("_-"))
            if end - start < 8 or not text.startswith(dot, end):
                return None
            end += len(dot)
        return end, True
    if kind == "forge":
        if text.startswith("gh", at) and text[at + 2 : at + 3] in tuple("pousr") and text.startswith("_", at + 3):
            end = run(text, at + 4, ALNUM)
            return (end, True) if end - at - 4 >= 36 else None
        end = run(text, at + 6, ALNUM | set("_-")) if text.startswith("glpat-", at) else at
        return (end, True) if end - at - 6 >= 20 else None
    end = run(text, at + 5, ALNUM | {"-"}) if text.startswith("xox", at) and text[at + 3 : at + 4] in tuple("abprs") and text.startswith("-", at + 4) else at
    return (end, True) if end - at - 5 >= 10 else None


def spans_plainly(text):
    out = []
    for rank, kind in enumerate(secret_scan.BASE_KINDS + secret_scan.ADDED_KINDS):
        at = 0
        while at < len(text or ""):
            found = match_at(kind, text, at)
            if found and found[1]:
                out.append((at, rank, kind, found[0]))
            at = found[0] if found else at + 1
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


def secret_texts(n=400):
    draw = random.Random(17)
    chars = lambda allowed, a, b: "".join(draw.choice(allowed) for _ in range(draw.randint(a, b)))
    word = DIGITS + LOWER + UPPER
    pieces = [
        lambda: draw.choice(["password", "PassWd", "secret", "Token", "api_key", "APIKEY"]) + draw.choice(["", "'", '"']) + draw.choice(["", " ", "  "]) + draw.choice(":=") + draw.choice(["", ' "', " "]) + chars(word + "+/_.=-", 1, 14),
        lambda: "AKIA" + chars(UPPER + DIGITS, 8, 16),
        lambda: chars("abcdef0123456789", 28, 40),
        lambda: "-----BEGIN " + draw.choice(["", "RSA ", "EC "]) + "PRIVATE KEY-----\n" + chars(word + "+/=\n", 1, 40) + draw.choice(["-----END RSA PRIVATE KEY-----", "-----END PRIVATE KEY-----", "-----END"]),
        lambda: "eyJ" + chars(word + "_-", 6, 12) + ".eyJ" + chars(word + "_-", 6, 12) + "." + chars(word + "_-", 6, 12),
        lambda: draw.choice(["ghp_", "gho_", "ghx_", "glpat-"]) + chars(word, 18, 40),
        lambda: draw.choice(["xoxb-", "xoxp-", "xoxz-"]) + chars(word + "-", 8, 14),
        lambda: chars("abcxyzAKIA -=:.'\"_ghé\n", 1, 12),
    ]
    return ["".join(draw.choice(pieces)() + draw.choice(["", " ", "\n", "."]) for _ in range(draw.randint(0, 8))) for _ in range(n)]


def test_all_seven_kinds_equal_a_plain_scan(spark, sf):
    texts = secret_texts()
    kinds = Counter()
    for text in texts:
        found = spans_plainly(text)
        assert secret_scan.find_spans(text) == found, text
        kinds.update(k for k, _, _ in found)
    assert all(kinds[k] >= 5 for k in secret_scan.BASE_KINDS + secret_scan.ADDED_KINDS), kinds
    given = {r.doc_id: r.text for r in table(spark, sf, "documents").select("doc_id", "text").collect()}
    for r in QUERIES["op10_secret_scan"](spark, sf).collect():
        assert r.spans == ",".join(f"{k}:{a}:{b}" for k, a, b in spans_plainly(given[r.doc_id]))


# --- exact copies ------------------------------------------------------------------------


def test_one_row_a_million_times(spark):
    """No array per repeated row: each is a row of its own throughout."""
    same = spark.range(1_000_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("").alias("text"))
    other = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 100).alias("text"))
    out = exact_dedup.decide(same.unionByName(other))
    found = out.groupBy("group_size").agg(F.count(F.lit(1)).alias("rows"), F.count_if("kept").alias("kept")).collect()
    assert {(r.group_size, r.rows, r.kept) for r in found} == {(1_000_000, 1_000_000, 1), (5, 500, 100)}


def test_runs_grow_with_the_rows():
    assert [exact_dedup.quotient_bits(n) for n in (0, 10**5, 10**7, 10**10)] == [1, 1, 6, 16]
