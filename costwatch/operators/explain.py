"""Prompts, explanations and their usage."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costwatch import settings
from costwatch.functions.measures import decimal_text
from costwatch.functions.text import strip, word_count
from costwatch.operators.verdict import default_explanation
from costwatch.staging import absolute, fresh_path, stage

GROUND_RULES = (
    "Explain the cost rise below in one or two sentences. Use only the figures and the note "
    "given here, name the note id, the route and the week, and add no other cause."
)
ANSWER_RULES = (
    "Answer the question from the numbered evidence only. Cite note ids, routes and weeks. "
    "Say so if the evidence does not establish a cause; a note counts as a cause only if it "
    "states a rise in cost."
)


NAMED = [("route", "route"), ("week_of", "week"), ("note_id", "note")]  # what an answer names of its evidence


def _percent(name: str) -> Column:
    return F.when(F.col(name).isNull(), "N/A").otherwise(
        F.concat(F.when(F.col(name) < 0, "-").otherwise(""), decimal_text(F.abs(name), 1), F.lit("%"))
    )


def ground_prompts(verdicts: DataFrame, note_texts: DataFrame) -> DataFrame:
    """One prompt per justified route-week, from its figures and its note (note_id, text)."""
    justified = verdicts.filter(F.col("flagged") == settings.JUSTIFIED)
    prompt = F.concat_ws(
        "\n",
        F.lit(GROUND_RULES),
        F.concat(F.lit("Route: "), "route"),
        F.concat(F.lit("Week: "), F.col("week_of").cast("string")),
        F.concat(F.lit("Cost per tonne-km: "), decimal_text(F.col("cost_per_tonne_km"), 2)),
        F.concat(F.lit("Against own history: "), _percent("vs_own_history_pct")),
        F.concat(F.lit("Against similar routes: "), _percent("vs_similar_routes_pct")),
        F.concat(F.lit("Note id: "), "note_id"),
        F.concat(F.lit("Note date: "), F.col("note_date").cast("string")),
        F.concat(F.lit("Note: "), "text"),
    )
    return justified.join(note_texts.select("note_id", "text"), "note_id").select(
        "route",
        "week_of",
        "note_id",
        "note_date",
        "snippet",
        "vs_own_history_pct",
        "vs_similar_routes_pct",
        prompt.alias("prompt"),
    )


PART_BYTES = 1 << 27  # of the evidence of questions that a task puts together
PROMPT_BYTES = 1 << 24  # of prompts that leave it at a time


def qa_prompts(questions: DataFrame, hits: DataFrame, docs: DataFrame) -> DataFrame:
    """One prompt per question with its evidence in rank order; null where nothing was found.

    `hits` is a top-k list, so the evidence of a question is bounded. Some documents are evidence
    of very many questions: a text goes once to each task that has such a question, and prompts
    are put together there. `prompt_words` is the number of words of the prompt.
    """
    described = [c for c in ("source_type", "route", "week_of", "note_id") if c in docs.columns]
    lines = F.concat_ws("\n", F.lit(""), *[F.concat(F.lit(f"{c}: "), c) for c in described], F.col("text"))
    told = [F.when(F.col(c) != "", F.concat(F.lit(f"{name} "), c)) for c, name in NAMED if c in docs.columns]
    hits = stage(hits.select("query_id", "document_id", "rank"), "evidence_hits")
    sizes = docs.select("document_id", F.octet_length("text").alias("size"))
    told_bytes = hits.join(sizes, "document_id").agg(F.sum("size")).first()[0] or 0
    n_parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-told_bytes // PART_BYTES))
    part = F.pmod(F.xxhash64("query_id"), F.lit(n_parts)).cast("int").alias("part")

    wanted = hits.select(part, "document_id").distinct()
    texts = docs.select("document_id", lines.alias("text"), F.concat_ws(", ", *told).alias("named"))
    texts = texts.join(wanted, "document_id")
    pick = F.struct("rank", "document_id")
    picks = hits.groupBy("query_id").agg(F.sort_array(F.collect_list(pick)).alias("picks"))
    asked = questions.select("query_id", F.concat(F.lit("QUESTION "), "text").alias("text"), part)
    asked = asked.join(picks, "query_id", "left").withColumn("kind", F.lit(1))
    rows = texts.withColumn("kind", F.lit(0)).unionByName(asked, allowMissingColumns=True)
    dealt = rows.repartitionById(n_parts, "part").sortWithinPartitions("kind")
    kinds = [f.schema[c].dataType.simpleString() for f, c in ((questions, "query_id"), (docs, "document_id"))]
    made = dealt.mapInArrow(
        _put_together,
        f"query_id {kinds[0]}, n_evidence bigint, best {kinds[1]}, best_evidence string, prompt string, prompt_words bigint",
    )
    return made.select(
        "query_id", "n_evidence", F.col("best").cast("string").alias("best_document"), "best_evidence", "prompt", "prompt_words"
    )


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prompts of the questions (`kind` 1) that come behind the texts (`kind` 0) of their evidence."""
    texts: dict = {}
    names = ["query_id", "n_evidence", "best", "best_evidence", "prompt", "prompt_words"]
    rules = ANSWER_RULES.encode()
    for batch in batches:
        column = {n: batch.column(n) for n in batch.schema.names}
        kinds = [column["query_id"].type, pa.int64(), column["document_id"].type, pa.string(), pa.binary(), pa.int64()]
        rows = zip(*(column[n].to_pylist() for n in ("kind", "query_id", "document_id")),
                   column["text"].cast(pa.binary()).to_pylist(),
                   *(column[n].to_pylist() for n in ("named", "picks")))
        out, held = [], 0

        def table() -> pa.RecordBatch:
            made = [pa.array(c, kind) for c, kind in zip(zip(*out), kinds)]
            return pa.record_batch([a.cast(pa.string()) if a.type == pa.binary() else a for a in made], names)

        for kind, query_id, document_id, text, named, picks in rows:
            if kind == 0:  # bytes are split at the blanks that `word_count` knows
                texts.setdefault(document_id, []).append((text, named, len(text.split())))
                continue
            found = sorted((p["rank"], p["document_id"], *t) for p in picks or () for t in texts.get(p["document_id"], ()))
            if not found:
                out.append((query_id, 0, None, None, None, None))
                continue
            blocks = b"\n\n".join(b"EVIDENCE %d%s" % (rank, text) for rank, _, text, _, _ in found)
            opening = b"\n\n".join([rules, *([] if text is None else [text])])
            # Blanks stand between all parts, so their words add up
            n_words = len(opening.split()) + sum(2 + f[4] for f in found)
            prompt = opening + b"\n\n" + blocks
            out.append((query_id, len(found), found[0][1], found[0][3], prompt, n_words))
            held += len(prompt)
            if held > PROMPT_BYTES:
                yield table()
                out, held = [], 0
        if out:
            yield table()


BATCH_SIZE = 32


ANSWERED = "prompt_hash string, made string, input_tokens bigint, output_tokens bigint"


def _answers(prompts: DataFrame, generator: Callable, batch_size: int, folder: str) -> DataFrame:
    """Answers (`ANSWERED`) to all prompts: those that `folder` has, and others that are asked.

    Each answered batch is a file there, renamed into place when it is whole. Batches are runs of
    prompts in order of their hashes, so a repeated task meets the files of its lost attempt and
    asks only what is missing; a second run leaves out every prompt that has an answer.
    """
    spark = prompts.sparkSession
    folder = absolute(spark, folder)
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    answered = spark.read.schema(ANSWERED).parquet(folder)
    hashed = prompts.select("prompt", F.sha2("prompt", 256).alias("prompt_hash")).distinct()
    missing = hashed.join(answered.select("prompt_hash"), "prompt_hash", "left_anti")
    missing = missing.repartition("prompt_hash").sortWithinPartitions("prompt_hash")

    def ask(frame: pd.DataFrame) -> pa.Table:
        made = pd.DataFrame(generator(list(frame["prompt"])), index=frame.index)
        texts = made["text"].fillna("").str.strip()
        if (texts == "").any():
            raise ValueError("the generator returned an empty text")
        counts = {c: pa.array(made[c].astype("int64")) for c in ("input_tokens", "output_tokens")}
        return pa.table({"prompt_hash": pa.array(frame["prompt_hash"]), "made": pa.array(texts), **counts})

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(folder)
        for frame in frames:
            for at in range(0, len(frame), batch_size):
                part = frame.iloc[at : at + batch_size]
                name = hashlib.sha256("".join(part["prompt_hash"]).encode()).hexdigest()
                done = f"{root}/{name}.parquet"
                if store.get_file_info(done).type == fs.FileType.NotFound:
                    unfinished = f"{root}/_{name}-{uuid.uuid4().hex}"  # Spark reads no such names
                    pq.write_table(ask(part), unfinished, filesystem=store)
                    store.move(unfinished, done)
                yield pq.read_table(done, filesystem=store, partitioning=None).to_pandas()

    asked = missing.mapInPandas(batches, ANSWERED)
    return answered.dropDuplicates(["prompt_hash"]).unionByName(asked)


def _generate(
    prompts: DataFrame, out: str, generator: Callable, batch_size: int = BATCH_SIZE, answers: str | None = None
) -> DataFrame:
    """Run an own generator, a function from a list of prompts to a list of dicts with
    `text`, `input_tokens` and `output_tokens`, on the executors, `batch_size` prompts a call.

    `answers` is a shared folder for answers that later runs go on from; default: a new one.
    """
    found = _answers(prompts, generator, batch_size, answers or fresh_path(prompts.sparkSession, "answers"))
    keyed = prompts.withColumn("prompt_hash", F.sha2("prompt", 256))
    return keyed.join(found, "prompt_hash").select(
        *prompts.columns, F.col("made").alias(out), "input_tokens", "output_tokens"
    )


def _fill(prompts: DataFrame, out: str, text: Column) -> DataFrame:
    text = F.when(strip(text) == "", F.raise_error(F.lit("empty explanation"))).otherwise(text)
    words = F.col("prompt_words") if "prompt_words" in prompts.columns else word_count(F.col("prompt"))
    counted = prompts.withColumn(out, text).withColumns({"input_tokens": words, "output_tokens": word_count(F.col(out))})
    return counted.drop("prompt_words")


def explain(
    prompts: DataFrame,
    generator: Callable | None = None,
    batch_size: int = BATCH_SIZE,
    answers: str | None = None,
) -> DataFrame:
    """Reason and token counts per prompt; an empty text is an error.

    Default: a sentence built from the row. Tokens are words then. With a generator, answers are
    kept in the folder `answers`, and a prompt that has one there is not asked again.
    """
    if generator is not None:
        return _generate(prompts, "reason", generator, batch_size, answers)
    return _fill(prompts, "reason", default_explanation())


def answer(
    prompts: DataFrame,
    generator: Callable | None = None,
    batch_size: int = BATCH_SIZE,
    answers: str | None = None,
) -> DataFrame:
    """Answer and token counts per question; one without evidence gets a fixed answer, free.

    Default: the best piece of evidence with its route, week and note.
    """
    none = F.lit(settings.NO_EVIDENCE_ANSWER)
    if generator is None:
        named = F.when(F.col("best_evidence") != "", F.concat(F.lit(" ("), "best_evidence", F.lit(")")))
        best = F.concat(
            F.lit("Best of "), F.col("n_evidence").cast("string"), F.lit(" pieces of evidence: "),
            "best_document", F.coalesce(named, F.lit("")), F.lit("."),
        )
        found = F.col("prompt").isNotNull()
        filled = _fill(prompts, "answer", F.when(found, best).otherwise(none))
        tokens = ("input_tokens", "output_tokens")
        return filled.withColumns({c: F.when(found, F.col(c)).otherwise(0) for c in tokens})
    prompts = stage(prompts.drop("prompt_words"), "prompts")  # read by both branches
    free = prompts.filter("prompt is null").withColumns(
        {
            "answer": none,
            "input_tokens": F.lit(0).cast("bigint"),
            "output_tokens": F.lit(0).cast("bigint"),
        }
    )
    asked = prompts.filter("prompt is not null")
    return _generate(asked, "answer", generator, batch_size, answers).unionByName(free)


def usage_cost(
    calls: DataFrame,
    input_price: float = settings.INPUT_PRICE_PER_MILLION,
    output_price: float = settings.OUTPUT_PRICE_PER_MILLION,
) -> DataFrame:
    """Calls, tokens and cost per model; prices are per million tokens.

    Without any call there is one row of zeros for the model `default`.
    """
    sums = calls.groupBy("model").agg(
        F.count(F.lit(1)).alias("llm_calls"),
        F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"),
        F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"),
    )
    zero = F.lit(0).cast("bigint")
    none = calls.agg(F.count(F.lit(1)).alias("n")).filter("n = 0")
    sums = sums.unionByName(
        none.select(
            F.lit(settings.DEFAULT_MODEL).alias("model"),
            *[zero.alias(c) for c in ("llm_calls", "input_tokens", "output_tokens")],
        )
    )
    cost_in = F.col("input_tokens") / 1_000_000 * input_price
    cost_out = F.col("output_tokens") / 1_000_000 * output_price
    return sums.withColumns(
        {
            "total_tokens": F.col("input_tokens") + F.col("output_tokens"),
            "input_price_per_million": F.lit(input_price),
            "output_price_per_million": F.lit(output_price),
            "estimated_input_cost": F.round(cost_in, 8),
            "estimated_output_cost": F.round(cost_out, 8),
            "estimated_total_cost": F.round(cost_in + cost_out, 8),
        }
    )
