"""The batch word count is a valid streaming aggregation (no extra operator)."""

from pyspark.sql import functions as F

from tessera.operators import words


def test_direct_word_count_on_a_file_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("ciao come va\nciao  ciao\n")
    stream = (spark.readStream.format("text").load(str(src))
              .select(F.lit(0).cast("long").alias("doc_id"), F.col("value").alias("text")))
    counts = words.word_count(stream, "direct")
    query = (counts.writeStream.outputMode("complete").format("memory").queryName("wc_stream")
             .option("checkpointLocation", str(tmp_path / "ckpt")).start())
    try:
        query.processAllAvailable()
        got = {r["word"]: r["n"] for r in spark.sql("SELECT * FROM wc_stream").collect()}
    finally:
        query.stop()
    assert got == {"ciao": 3, "come": 1, "va": 1, "": 1}
