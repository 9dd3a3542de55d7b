"""Op 8's verdict on labels that were not fitted."""

from pyspark.sql import functions as F

from kredo.llm import quality_rules
from kredo.llm.common import fold, id_and_text, read

SF = "/root/testdata/sf0.01"


def test_verdict_on_labels_that_were_not_fitted(spark):
    docs = id_and_text(read(spark, SF, "documents"))
    labels = quality_rules.quality_labels(read(spark, SF, "labels")).withColumn("held", fold("doc_id", 3) == 1)
    model = quality_rules.fit(docs, labels.where("NOT held").drop("held"))
    judged = quality_rules.score(docs, model).join(labels.where("held"), "doc_id")
    n = {(r["target"], r["kept"]): r["n"] for r in judged.groupBy("target", "kept").agg(F.count(F.lit(1)).alias("n")).collect()}
    good, bad = [sum(v for (t, _), v in n.items() if t == k) for k in (1, 0)]
    print(n)
    assert good > 50 and bad > 8
    kept, precision = n.get((1, True), 0) / good, n.get((1, True), 0) / max(1, n.get((1, True), 0) + n.get((0, True), 0))
    assert kept >= 0.95 and precision >= 0.95
