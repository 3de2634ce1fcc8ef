"""Questions as a stream: each micro-batch of questions is answered by the batch scorer.

File source of question rows -> ``foreachBatch`` -> relevant sentences per article, written to a Parquet table partitioned
by ``batch``. The weights of every question depend on all questions asked (their number and token frequencies), so the
questions are kept as a table beside the output, one partition per micro-batch, and every batch answers all of them anew:
``latest_answers`` is the same however the questions are split into files. The corpus side (sentences and, unless
their source works them out, word vectors) is stored once and read by every batch. The checkpoint folder makes the stream restartable, and a replayed batch
overwrites its own partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentsift.operators import retrieve, sentences
from sentsift.operators.vectors import HashedVectors


def answer_stream(spark: SparkSession, question_path: str, sentences_tok: DataFrame, vocab: DataFrame | HashedVectors,
                  out_path: str, checkpoint: str, schema: str = "item_id long, text string",
                  available_now: bool = True, max_files_per_trigger: int | None = None,
                  file_filter: str | None = None):
    """Start the stream over the folder ``question_path`` (new files become new
    micro-batches; ``file_filter`` is a file-name glob); returns the query."""
    reader = spark.readStream.schema(schema)
    if file_filter:
        reader = reader.option("pathGlobFilter", file_filter)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    qs = reader.parquet(question_path)

    spark_of = sentences_tok.sparkSession
    sentences_tok.write.mode("overwrite").parquet(f"{out_path}/corpus/sentences")
    stored, known = spark_of.read.parquet(f"{out_path}/corpus/sentences"), vocab
    if not isinstance(vocab, HashedVectors):
        vocab.write.mode("overwrite").parquet(f"{out_path}/corpus/vectors")
        known = spark_of.read.parquet(f"{out_path}/corpus/vectors")

    def answer(batch: DataFrame, epoch: int) -> None:
        new = batch.select(F.col("item_id").alias("q_id"), F.col("text").alias("question"))
        new.write.mode("overwrite").parquet(f"{out_path}/questions/batch={epoch}")
        asked = spark.read.parquet(f"{out_path}/questions").where(F.col("batch") <= epoch).drop("batch")
        rel = retrieve.relevant_sentences(stored, sentences.question_frame(asked), known)
        rel.write.mode("overwrite").parquet(f"{out_path}/answers/batch={epoch}")

    w = qs.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def latest_answers(spark: SparkSession, out_path: str) -> DataFrame:
    """``(doc_id, sentence, score)`` of the last finished micro-batch: the answers to all questions so far."""
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{out_path}/answers/batch=*/_SUCCESS")
    found = done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(done)
    epochs = [int(f.getPath().getParent().getName().removeprefix("batch=")) for f in found]
    schema = "doc_id long, sentence string, score double"
    if not epochs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{out_path}/answers/batch={max(epochs)}")
