"""The registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame."""

import zlib

from pyspark.sql import functions as F

from placelens.llm import alignment, ann, exact_dedup, langid, lattice, mixing, packing, periodic_runs, sharding, simhash, token_counts, toxicity, url_rules
from placelens.llm.common import measured_join, plain_lower, stored, table
from placelens.session import shared_folder


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.verdicts(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def tokenizer_file(name="byte_bpe_50k.json"):
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file()).withColumnRenamed("id", "doc_id")


def op3_sharding(spark, sf_dir):
    return sharding.interleave(table(spark, sf_dir, "documents"), 8).select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op5_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


def op6_nearest(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op7_token_counts(spark, sf_dir):
    """Every document is counted and inserted; then toxic ones are deleted and low-quality ones lower-cased, recounted and revised.

    That batch is delivered twice, as after a lost acknowledgement. A third one moves the other documents of high quality to another tokenizer version.
    """
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.min("quality").alias("quality")
    )
    docs = measured_join(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"), labels, "doc_id", "left")
    step = F.when(F.col("toxic") == 1, "delete").when(F.col("quality") == 0, "revise").when(F.col("quality") == 1, "move")
    texts = docs.withColumn("step", step).select(
        "source", "lang", "step", "text",
        F.when(F.col("step") == "revise", plain_lower(F.col("text"))).alias("lower"),
        F.when(F.col("step") == "move", F.col("text")).alias("moved"),
    )
    plain, word = tokenizer_file(), tokenizer_file("word_bpe_49k.json")
    for column, file, into in (("text", plain, "first"), ("lower", plain, "second"), ("moved", word, "third")):
        texts = token_counts.counted(texts, file, column, into)
    rows = stored(texts, "token-counts")

    def changes(part, kind, new_version, tokens):
        old = [F.col(name).alias(f"old_{name}") for name in ("source", "lang")]
        old += [F.lit("byte_bpe_50k").alias("old_version"), F.col("first").alias("old_tokens")]
        return part.select(kind.alias("kind"), "source", "lang", F.lit(new_version).alias("version"), F.col(tokens).alias("tokens"), *old)

    rollup = shared_folder(spark, "rollup")
    inserts = changes(rows, F.lit("insert"), "byte_bpe_50k", "first")
    edits = changes(rows.where("step IN ('delete', 'revise')"), F.col("step"), "byte_bpe_50k", "second")
    moves = changes(rows.where("step = 'move'"), F.lit("revise"), "word_bpe_49k", "third")
    for batch, part in (("0", inserts), ("1", edits), ("1", edits), ("2", moves)):
        token_counts.commit(part, rollup, batch)
    return token_counts.totals(spark, rollup)


def op8_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    learned = langid.profiles(docs.where(~F.coalesce(held_out, F.lit(False))))
    return langid.predict(docs, learned, ["doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out")])


def op9_url_rules(spark, sf_dir):
    return url_rules.judged(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    rows = stored(toxicity.labelled(docs.where(~held_out), table(spark, sf_dir, "labels")), "labelled")
    found = toxicity.score(docs, toxicity.train(rows))
    return found.withColumnRenamed("id", "doc_id").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op11_embedding_dedup(spark, sf_dir):
    return lattice.linked(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def run_report(found):
    """Digests of the runs and collapsed texts that `periodic_runs` finds, and the run of the most periods."""

    def periods(run, other):
        more = run["length"] * other["period"] - other["length"] * run["period"]
        later = F.when(run["start"] != other["start"], run["start"] - other["start"]).otherwise(run["period"] - other["period"])
        return F.signum(F.when(more != 0, -more).otherwise(later)).cast("int")

    line = lambda run: F.concat(run["start"].cast("string"), F.lit(","), run["length"].cast("string"), F.lit(","), run["period"].cast("string"), F.lit("\n"))
    return found.withColumn("_best", F.get(F.array_sort("runs", periods), 0)).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("_best.start"),
        F.col("_best.length"),
        F.col("_best.period"),
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def with_tail_repeated(doc_id, words):
    """The contract's rewriting: one document in ten repeats a part of itself from some word on."""
    hashed = zlib.crc32(str(doc_id).encode())
    if doc_id is None or hashed % 10 or not words:
        return words
    count, draw = len(words), hashed // 10
    begin = draw % count
    period = 1 + (count - begin) // (3 + draw % 8)
    return words[:begin] + [words[begin + at % period] for at in range(count - begin)]


def op12_periodic_runs(spark, sf_dir):
    return run_report(periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), reworded=with_tail_repeated))


def op13_alignment(spark, sf_dir):
    found = alignment.aligned(table(spark, sf_dir, "documents"), tokenizer_file(), tokenizer_file("piece_bpe_32k.model"))
    return found.withColumnRenamed("id", "doc_id")


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_packing, op3_sharding, op4_simhash, op5_mixing, op6_nearest, op7_token_counts, op8_language_id, op9_url_rules, op10_toxicity, op11_embedding_dedup, op12_periodic_runs, op13_alignment)}
