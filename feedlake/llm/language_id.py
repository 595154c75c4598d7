r"""Language identification: words first, then shorter and shorter character n-grams.

A word is a run of letters in lower case.  A known word scores, for each language, the log of
its smoothed relative frequency there.  An unseen word is looked up by its character n-grams, with
``^`` and ``$`` at its ends: the longest order of which any n-gram is known scores, by the mean
of its known n-grams.  The scores of all words of a text add up; with the log priors they give
the posterior of each language, and the largest wins.

Fitting reads whole texts of a bounded, documented sample: about ``sample_rows`` rows per language,
picked by a hash of id and text, so that copies of a text are picked one by one; without an id column
they are taken together.  Words and n-grams are counted by Spark, and all words and n-grams of the sample are
*known*.  Their number is counted before any of them leaves Spark: a model of more than ``most_cells`` (kinds times
languages) is refused, which a smaller sample mends.  The driver reads them order by order and partition by partition, one row
per word or n-gram.

Rows.  A text that is null or has no letter is ``und``, with score 0.  A text with letters but
nothing known gets the priors.  Ties go to the language first in the alphabet.  Texts are read
whole, repeated rows are judged alike.  Rows with a null language or text teach nothing; without
any lesson every text is ``und``.  The prediction is one new struct column, all others are kept.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import remove, sampled, ship, store

_WORD = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
#: Distinct words a task counts before it hands them on, and unseen words a task remembers.
_HELD = 200_000


@dataclass(frozen=True)
class Settings:
    sample_rows: int = 5_000
    most_cells: int = 50_000_000
    orders: tuple[int, ...] = (5, 4, 3, 2, 1)
    smoothing: float = 0.5


def words(text: str | None) -> list[str]:
    """Runs of letters, in lower case; runs of numerals only, such as fractions, are none."""
    if not text:
        return []
    found = _WORD.findall(text.lower())
    return found if text.isascii() else [w for w in found if w.isascii() or any(map(str.isalpha, w))]


def count_words(labelled: DataFrame) -> DataFrame:
    """``lang``, ``word``, ``n`` over the columns ``lang`` and ``text``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Counter] = {}

        def out() -> pd.DataFrame:
            rows = [(lang, w, n) for lang, c in held.items() for w, n in c.items()]
            held.clear()
            return pd.DataFrame(rows, columns=["lang", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                held.setdefault(lang, Counter()).update(words(text))
            if sum(map(len, held.values())) > _HELD:
                yield out()
        yield out()

    return labelled.mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def count_grams(counted: DataFrame, orders: tuple[int, ...]) -> DataFrame:
    """``lang``, ``order``, ``gram``, ``n``: character n-grams of all counted words."""
    padded = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    # A word shorter than the order has no n-gram of it.
    grams = counted.select("lang", "n", padded.alias("padded")).select(
        "lang",
        "n",
        F.explode(F.array(*[F.lit(k) for k in orders])).alias("order"),
        "padded",
    )
    each = F.transform(F.sequence(F.lit(1), F.expr("length(padded) - order + 1")), lambda i: F.substr(F.col("padded"), i, F.col("order")))
    return (
        grams.filter("length(padded) >= order")
        .select("lang", "order", "n", F.explode(each).alias("gram"))
        .groupBy("lang", "order", "gram")
        .agg(F.sum("n").alias("n"))
    )


class Model:
    """Log frequencies: one row per known word or n-gram, one column per language."""

    def __init__(self, langs: list[str], priors: np.ndarray, tables: dict[int, tuple[dict[str, int], np.ndarray]], orders: tuple[int, ...]):
        self.langs, self.priors, self.tables, self.orders = langs, priors, tables, orders
        self._unseen: dict[str, np.ndarray | None] = {}

    @classmethod
    def build(cls, known: DataFrame, totals: pd.DataFrame, priors: dict[str, int], settings: Settings) -> Model:
        """``known``: order (0 for words), gram, counts (lang, n); ``totals``: lang, order, total, kinds."""
        langs = sorted(priors)
        column = {lang: i for i, lang in enumerate(langs)}
        shares = np.array([priors[lang] for lang in langs], float)
        tables = {}
        for order in (0, *settings.orders):
            all_, number, cells = totals[totals["order"] == order], {}, array("d")
            for row in known.filter(F.col("order") == order).select("gram", "counts").toLocalIterator():
                number[row["gram"]] = len(number)
                line = [0.0] * len(langs)
                for lang, n in row["counts"]:
                    line[column[lang]] = n
                cells.extend(line)
            counts = np.array(cells).reshape(len(number), len(langs))
            total, kinds = np.zeros(len(langs)), max(1, int(all_["kinds"].max())) if len(all_) else 1
            total[all_["lang"].map(column).to_numpy(int)] = all_["total"]
            tables[order] = number, np.log((counts + settings.smoothing) / (total + settings.smoothing * kinds))
        return cls(langs, np.log(shares / shares.sum()) if langs else shares, tables, settings.orders)

    def unseen(self, word: str) -> np.ndarray | None:
        """Score of a word that is not known; None if none of its n-grams is known either."""
        if word in self._unseen:
            return self._unseen[word]
        if len(self._unseen) >= _HELD:
            self._unseen.clear()
        padded, score = f"^{word}$", None
        for order in self.orders:
            number, logs = self.tables[order]
            known = [i for at in range(len(padded) - order + 1) if (i := number.get(padded[at : at + order])) is not None]
            if known:
                score = logs[known].mean(0)
                break
        self._unseen[word] = score
        return score

    def predict(self, text: str | None) -> tuple[str, float]:
        found = words(text)
        if not found or not self.langs:
            return UNDETERMINED, 0.0
        number, logs = self.tables[0]
        total, rows, times = self.priors.copy(), [], []
        for word, n in Counter(found).items():
            i = number.get(word)
            if i is not None:
                rows.append(i)
                times.append(n)
            elif (score := self.unseen(word)) is not None:
                total += n * score
        if rows:
            total += np.array(times, float) @ logs[rows]
        odds = np.exp(total - total.max())
        best = int(odds.argmax())  # the first of equals
        return self.langs[best], float(odds[best] / odds.sum())


def fit(
    labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", settings: Settings = Settings(), id_col: str | None = None
) -> Model:
    """Learn from rows with a language and a text; ``id_col`` only helps to pick the sample."""
    ship(labelled.sparkSession)
    row_id = F.col(id_col) if id_col else F.lit(None)
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), row_id.alias("id"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["rows"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).collect()}
    counted = store(count_words(sampled(rows, "lang", settings.sample_rows, sizes, "id", "text").select("lang", "text")), "words")
    grams = store(
        count_grams(counted, settings.orders).unionByName(
            counted.select("lang", F.lit(0).alias("order"), F.col("word").alias("gram"), "n")
        ),
        "grams",
    )
    # One row per language and order.
    totals = grams.groupBy("lang", "order").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).toPandas()
    cells = int(totals["kinds"].sum()) * max(1, len(sizes))  # at least as many as the model will have
    if cells > settings.most_cells:
        raise ValueError(f"a model of {cells} cells; at most {settings.most_cells}: take fewer sample_rows")
    # One row per gram, with its counts of all languages.
    by_gram = grams.groupBy("order", "gram").agg(F.collect_list(F.struct("lang", "n")).alias("counts"))
    known = store(by_gram, "known")
    model = Model.build(known, totals, sizes, settings)
    for used in (counted, grams, known):
        remove(used)
    return model


def predictor(model: Model, spark):
    """The model as a function of a text column: struct of ``lang`` and ``score``."""
    ship(spark)
    ready = spark.sparkContext.broadcast(model)

    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([ready.value.predict(t) for t in texts], columns=["lang", "score"])

    udf = F.pandas_udf(predict, "lang string, score double").asNondeterministic()  # evaluated once

    def apply(text: Column) -> Column:
        return udf(text)

    return apply
