"""Labels and scores from a model behind a plain callable.

The model is a function from prompts to texts; a real one calls a server, tests
and examples use a rule.  Rows that have a label already are left out, so a run
that broke off goes on where it stopped.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.errors import PublicationError, SchemaError
from lexmill.functions import values as V
from lexmill.operators import integrity as I
from lexmill.operators import joins as J
from lexmill.schemas import contract
from lexmill.storage import materialize
from lexmill.streaming.batches import run_batches

Engine = Callable[[Sequence[str]], Sequence[str]]
#: Attempts after the first before evidence that doesn't fit is cleared.
REPAIRS = 3


def ask(rows: DataFrame, prompt: str, engine: Engine, *, key: str = "sentence_id", output: str = "response") -> DataFrame:
    """``key`` and the engine's answer, a batch at a time."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = list(engine(batch["__prompt"].tolist()))
            if len(answers) != len(batch):
                raise ValueError(f"the engine returned {len(answers)} answers for {len(batch)} prompts")
            yield pd.DataFrame({key: batch[key], output: answers})

    return rows.select(key, F.col(prompt).alias("__prompt")).mapInPandas(run, f"{key} {kind}, {output} string")


def scored(rows: DataFrame, prompt: str, engine: Engine, *, key: str = "sentence_id") -> DataFrame:
    """Binary labels with log-probabilities, from completions that list the first token's alternatives."""
    pair = ask(rows, prompt, engine, key=key).select(key, V.first_token_scores(F.col("response")).alias("s"))
    yes, no = F.col("s.yes"), F.col("s.no")
    label = F.when(yes - no > 0, "yes").when((yes - no).isNotNull(), "no")
    return pair.select(key, label.alias("place_relevance"), yes.alias("yes_logprob"), no.alias("no_logprob"), V.logit_margin(yes, no).alias("logit_margin"), V.two_class_probability(yes, no).alias("two_class_probability"))


def labelled(rows: DataFrame, prompt: str, target: str, engine: Engine, *, key: str = "sentence_id", repairs: int = REPAIRS) -> DataFrame:
    """Five label fields, with how often a response was repaired and why one failed for good.

    Responses that break the contract go back with the reason, so many times;
    then evidence that doesn't fit is cleared, and anything else is a failure.
    """
    kind = rows.schema[key].dataType.simpleString()
    todo = rows.select(key, F.col(prompt).alias("p"), F.col(target).alias("t"))
    done: DataFrame | None = None
    for attempt in range(repairs + 1):
        answers = ask(todo, "p", engine, key=key).join(todo, key)
        judged = materialize(answers.withColumn("failure", V.label_failure(F.col("response"), F.col("t"))).withColumn("repairs", F.lit(attempt)), "labels")
        last = attempt == repairs
        fine = judged if last else judged.where("failure IS NULL")
        fine = fine.select(key, "response", "failure", "repairs")
        done = fine if done is None else done.unionByName(fine)
        bad = judged.where("failure IS NOT NULL")
        if last or not bad.take(1):
            break
        note = F.concat(F.lit(f"\n\nRepair attempt {attempt + 1}: the last response was rejected because "), F.col("failure"), F.lit("."))
        todo = bad.select(key, F.concat("p", note).alias("p"), "t")

    def clear(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cleared = batch["failure"].fillna("").str.startswith("evidence")
            batch.loc[cleared, "response"] = [json.dumps({**json.loads(r), "evidence": ""}, ensure_ascii=False) for r in batch.loc[cleared, "response"]]
            batch.loc[cleared, "failure"] = None
            yield batch

    repaired = done.mapInPandas(clear, f"{key} {kind}, response string, failure string, repairs int")
    return repaired.select(key, *[F.when(F.col("failure").isNull(), F.get_json_object("response", f"$.{f}")).alias(f) for f in V.FIELDS], "failure", "repairs")


def load_input(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Rows to label, with the columns that ``two_label_input`` or ``place_input`` asks for, whatever their types."""
    rows, wanted = spark.read.parquet(path), contract(table).names
    if missing := sorted(set(wanted) - set(rows.columns)):
        raise SchemaError(f"{table}: missing {', '.join(missing)}")
    return rows


def label_batches(rows: DataFrame, prompt: str, target: str, engine: Engine, root: str, identity: dict, *, batches: int, key: str = "sentence_id", progress: Callable[[dict], None] | None = None) -> DataFrame:
    """``labelled`` in batches below ``root``: a run that broke off asks the model only for batches that are not there."""
    return run_batches(rows, root, identity, lambda part: labelled(part, prompt, target, engine, key=key), batches=batches, key=key, progress=progress)


def score_batches(rows: DataFrame, prompt: str, engine: Engine, root: str, identity: dict, *, batches: int, key: str = "sentence_id", progress: Callable[[dict], None] | None = None) -> DataFrame:
    """``scored`` in batches below ``root``."""
    return run_batches(rows, root, identity, lambda part: scored(part, prompt, engine, key=key), batches=batches, key=key, progress=progress)


def repair_statistics(labels: DataFrame) -> DataFrame:
    return labels.groupBy(F.coalesce("failure", F.lit("")).alias("failure")).agg(F.count("*").alias("n"), F.count_if(F.col("repairs") > 0).alias("repaired"))


def resume(rows: DataFrame, done: DataFrame | None, *, key: str = "sentence_id") -> DataFrame:
    """Rows without a label yet; what is there must belong to the rows, once each."""
    if done is None:
        return rows
    I.assert_all({"a label repeats": I.duplicate_keys(done, key), "a label has no row": I.orphans(done, key, rows, key)})
    return J.pending(rows, done, key)


def score_faults(scores: DataFrame) -> DataFrame:
    """Rows whose log-probabilities are no numbers, or whose label or derived columns are not what they give."""
    yes, no = F.col("yes_logprob"), F.col("no_logprob")
    fine = F.lit(True)
    for x in (yes, no):
        fine = fine & ~F.isnan(x) & (F.abs(x) < float("inf"))
    for name, value in (("logit_margin", V.logit_margin(yes, no)), ("two_class_probability", V.two_class_probability(yes, no))):
        fine = fine & (F.abs(F.col(name) - value) <= F.greatest(F.lit(1e-12), 1e-12 * F.greatest(F.abs(F.col(name)), F.abs(value))))
    fine = fine & (F.col("place_relevance") == F.when(yes > no, "yes").otherwise("no"))
    return scores.where(~F.coalesce(fine, F.lit(False))).select(F.col("sentence_id").cast("string").alias("offender"))


def check_scores(scores: DataFrame) -> None:
    """Derived columns are what their log-probabilities give."""
    if n := score_faults(scores).count():
        raise PublicationError(f"{n} scores don't fit their log-probabilities")
