"""Reading level of each document.

Method: graded texts (documents with a rated band) tell at which grade a word is acquired: the
expected band of a word under its rate in each band. A document's level is predicted from quantiles
of the grades of its known words, calibrated on the graded texts by a linear discriminant. Grades used
to calibrate a text come from the other texts only.

The model is fitted on a bounded sample: ``SAMPLE`` graded documents by hash order. Everything else
runs over all documents in one pass; only the words of the sample's texts travel.

Defined results
* fewer than ``LEAST`` words of English prose: no row; null and empty texts have none;
* words never graded are ignored; a document with none gets the most frequent band;
* no graded documents, or fewer than two bands among them: no rows (there is no scale);
* repeated ratings count once; raters who disagree share a document's vote;
* texts of any length are read whole; repeated document rows are graded each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.llm import prose
from trackspark.session import durable

#: The scale, from easy to hard.
BANDS = ("elementary", "secondary", "advanced")
#: Words of prose a document needs.
LEAST = 40
#: Largest number of graded documents used to fit.
SAMPLE = 4000
#: Graded documents a word needs for a grade, at every size.
SUPPORT = 2
#: Parts of the graded documents, each calibrated with word grades of the others.
FOLDS = 5
#: Quantiles of a document's word grades.
QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9)


def _sample_words(it):
    import pandas as pd

    for pdf in it:
        pdf["words"] = [prose.words(t) if isinstance(t, str) else [] for t in pdf["text"]]
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "grade": pdf["grade"], "words": pdf["words"]})


def features(words: list[str], grades: dict[str, float]) -> list[float] | None:
    """Quantiles and mean of the grades of the known words; None without any."""
    known = sorted(grades[w] for w in words if w in grades)
    if not known:
        return None
    n = len(known)
    return [known[min(int(q * n), n - 1)] for q in QUANTILES] + [sum(known) / n]


def word_counts(d: DataFrame) -> tuple[list, list]:
    """(sizes, rows) from graded documents (fold, grade: votes by band, words).

    ``sizes`` has the votes of each fold by band; a row has a word, its documents of each fold and its
    votes of each fold by band. Words of fewer than ``SUPPORT`` documents are left out.
    """
    cell = lambda f, b: F.sum(F.when(F.col("fold") == f, F.col("grade")[b]).otherwise(F.lit(0.0)))
    counts = lambda: F.array(*[F.count_if(F.col("fold") == f) for f in range(FOLDS)])
    votes = lambda: F.array(*[F.array(*[cell(f, b) for b in range(len(BANDS))]) for f in range(FOLDS)])
    sizes = d.agg(votes().alias("v")).first()["v"]
    per = d.select("fold", "grade", F.explode(F.array_distinct("words")).alias("w")).groupBy("w").agg(counts().alias("n"), votes().alias("v"))
    return sizes, per.filter(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x) >= SUPPORT).collect()


def word_grades(sizes: list, rows: list, without: int | None = None) -> dict[str, float]:
    """Acquisition grade of each word; documents of the fold ``without`` do not count.

    Rates are per band, so that a band with many texts pulls no word towards it; a grade with little
    support is drawn to the middle of the scale.
    """
    folds, bands = [f for f in range(FOLDS) if f != without], range(len(BANDS))
    size = [sum(sizes[f][b] or 0.0 for f in folds) for b in bands]
    middle, out = (len(BANDS) - 1) / 2, {}
    for r in rows:
        n = sum(r.n[f] for f in folds)
        if n < SUPPORT:
            continue
        rate = [(sum(r.v[f][b] for f in folds) + 0.05) / (size[b] + 1.0) for b in bands]
        grade = sum(b * x for b, x in enumerate(rate)) / sum(rate)
        out[r.w] = middle + (grade - middle) * n / (n + 1.0)
    return out


def calibrate(x: list[list[float]], votes: list[list[float]]):
    """Linear discriminant over features: (weights, offsets) of each band, or None."""
    import numpy as np

    f, v = np.asarray(x, dtype=float), np.asarray(votes, dtype=float)
    have = v.sum(axis=0)
    if len(f) == 0 or (have > 0).sum() < 2:
        return None
    means = np.stack([(v[:, b : b + 1] * f).sum(axis=0) / max(have[b], 1e-9) for b in range(len(BANDS))])
    cov = np.zeros((f.shape[1], f.shape[1]))
    for b in range(len(BANDS)):
        c = f - means[b]
        cov += (v[:, b : b + 1] * c).T @ c
    cov = cov / have.sum() + 0.01 * np.eye(f.shape[1])
    w = np.linalg.solve(cov, means.T).T
    off = np.where(have > 0, -0.5 * (w * means).sum(axis=1), -np.inf)
    return w, off


def fit(documents: DataFrame, labels: DataFrame):
    """(word grades, discriminant, most frequent band) from the graded documents, or None."""
    votes = labels.filter(F.col("band").isin(*BANDS) & F.col("doc_id").isNotNull()).select("doc_id", "rater", "band").distinct()
    share = votes.groupBy("doc_id").agg(F.array(*[F.avg((F.col("band") == b).cast("double")) for b in BANDS]).alias("grade"))
    sample = share.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    graded = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # SAMPLE rows at most
    words = graded.select("doc_id", "grade", "text").mapInPandas(_sample_words, "doc_id long, grade array<double>, words array<string>")
    words = durable(words.filter(F.size("words") >= LEAST).withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int")))
    counted = word_counts(words)
    grades = word_grades(*counted)
    if not grades:
        return None
    # a document's own words must not have graded it: each fold is calibrated with the grades of the others
    unseen = [word_grades(*counted, without=f) for f in range(FOLDS)]

    def feats(it):
        import pandas as pd

        for pdf in it:
            x = [features(list(w), unseen[f]) for w, f in zip(pdf["words"], pdf["fold"])]
            yield pd.DataFrame({"grade": pdf["grade"], "x": x})

    rows = [(list(r.x), list(r.grade)) for r in words.mapInPandas(feats, "grade array<double>, x array<double>").collect() if r.x is not None]  # SAMPLE rows at most
    lda = calibrate([x for x, _ in rows], [g for _, g in rows])
    if lda is None:
        return None
    usual = max(range(len(BANDS)), key=lambda b: sum(g[b] for _, g in rows))
    return grades, lda, usual


def predict(words: list[str], model) -> str:
    grades, (w, off), usual = model
    x = features(words, grades)
    if x is None:
        return BANDS[usual]
    return BANDS[max(range(len(BANDS)), key=lambda b: float(sum(a * c for a, c in zip(w[b], x)) + off[b]))]


def levels(documents: DataFrame, model) -> DataFrame:
    """(doc_id, n_words, band) of every document with enough prose."""
    docs = documents.select("doc_id", "text")
    schema = "doc_id long, n_words long, band string"
    if model is None:
        return docs.sparkSession.createDataFrame([], schema)
    grades, (w, off), usual = model
    model = (grades, ([list(map(float, r)) for r in w], [float(o) for o in off]), usual)

    def grade(it):
        import pyarrow as pa

        for batch in it:
            ids, n, band = [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = prose.words(text.as_py())
                if len(found) >= LEAST:
                    ids.append(i)
                    n.append(len(found))
                    band.append(predict(found, model))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(band, pa.string())], ["doc_id", "n_words", "band"])

    return docs.mapInArrow(grade, schema)
