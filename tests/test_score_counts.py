from pyspark.sql import functions as F

from kestrel.operators import metrics as mt
from kestrel.plans import score_views as sv
from kestrel.plans.q_metrics import score_table

SCHEMA = "model_key string, row_id long, fold int, y int, score double, pred int, split string"


def _rows():
    out = []
    for i in range(2000):
        y = None if i % 41 == 0 else int(i % 3 == 0)
        score = None if i % 37 == 0 else (i * 7 % 11) / 11 + (y or 0) * 0.2
        out.append((("a", "b")[i % 2], i, i % 5 + 1, y, score, None if score is None else int(score > 0.5), ("test", "train")[i % 4 // 2]))
    return out


def test_counted_rows_give_the_same_metrics(spark):
    sc = spark.createDataFrame(_rows(), SCHEMA)
    counted = sc.groupBy(*[c for c in sc.columns if c != "row_id"]).agg(F.count(F.lit(1)).alias("n_rows"))
    assert counted.count() < sc.count()
    for metric in (lambda s: mt.confusion_matrix(s, ["model_key"]), lambda s: mt.fold_metrics(s), lambda s: mt.oof_metrics(s),
                   lambda s: mt.roc_curve(s, ["model_key"]), lambda s: mt.pr_curve(s, ["model_key"]),
                   lambda s: mt.classification_report(s, ["model_key"])):
        def rounded(df):
            return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.fillna(-1).collect())
        assert rounded(metric(sc)) == rounded(metric(counted))


def test_the_written_score_table_does_not_grow_with_the_rows(spark, monkeypatch):
    rows = lambda n: spark.range(n).selectExpr("id AS row_id", "int(id % 5 = 0) AS IsBadBuy", "10000 + id % 50 AS VehBCost")
    size = []
    for n in (20_000, 60_000):
        monkeypatch.setattr(sv.proxies, "auction", lambda *_, n=n: rows(n))
        t = score_table(spark, "")
        assert t.groupBy().agg(F.sum("n_rows")).first()[0] == 25 * n
        size.append(t.count())
    assert size[1] < 1.05 * size[0] < 20_000
