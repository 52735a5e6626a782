"""Jobs that call a user's model: pair scores with retry, and item extraction from images.

Calls of a task run side by side, each with a deadline of its own and all of a batch with one in common (`Limits`). A call that is late is given up: its answer is null, and its thread, which can't be stopped, holds
neither the batch nor the end of the task. Answers come back in the order of the rows.
"""

from __future__ import annotations

import json
import random
import threading
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.text import first_number
from shelfmark.operators.clean import valid_items
from shelfmark.sources.tables import ITEMS
from shelfmark.sources.work import spread, store

LABELS = (1, 2, 3)


@dataclass(frozen=True)
class Limits:
    """How many calls run at once in a task, how many seconds a call and a batch of `rows` calls may take, and a pause after every so many calls that are sent."""

    at_once: int = 100
    call: float = 45.0
    batch: float = 180.0
    pause: float = 0.02
    every: int = 5
    rows: int = 1000


@dataclass(frozen=True)
class Tries:
    """How often a call without a result is made in a round, with waits that grow by a factor and differ by up to `jitter` seconds."""

    most: int = 3
    delay: float = 2.0
    growth: float = 1.5
    jitter: float = 1.0

    def longest(self, call: float) -> float:
        return self.most * call + sum(self.delay * self.growth**i + self.jitter for i in range(self.most - 1))


def answers(call: Callable, arguments: list[tuple], limits: Limits, longest: float | None = None) -> list[tuple[object, float | None]]:
    """(answer, seconds) of each call, in order; None for a call that fails, is late or is left when the batch's time is up, seconds None unless it returned in time."""
    out: list[tuple[object, float | None]] = [(None, None)] * len(arguments)
    lock, sending, finished = threading.Lock(), threading.Lock(), threading.Event()
    left, running, patience = iter(range(len(arguments))), {}, longest or limits.call
    live, taken = min(limits.at_once, len(arguments)), True

    def send() -> int | None:
        """The next call, which is late from its time in `running` on."""
        with sending:
            with lock:
                i = next(left, None) if taken else None
            if i and limits.pause and i % limits.every == 0:
                time.sleep(limits.pause)
            with lock:
                if i is None or not taken:
                    return None
                running[i] = time.monotonic() + patience
                return i

    def work() -> None:
        """One call after the other, without a word to the batch's own thread but by the last; a thread whose call was given up ends, as another took its place."""
        nonlocal live
        while (i := send()) is not None:
            began = time.monotonic()
            try:
                answer = call(*arguments[i])
            except Exception:  # noqa: BLE001  a model's failure is a null answer
                answer = None
            now = time.monotonic()
            with lock:
                if (until := running.pop(i, None)) is None:
                    return
                if now <= until:
                    out[i] = answer, now - began
        with lock:
            live -= 1
            if not live:
                finished.set()

    end = time.monotonic() + limits.batch
    for _ in range(live):
        threading.Thread(target=work, daemon=True).start()
    while live and (now := time.monotonic()) < end:
        with lock:
            late = [i for i, until in running.items() if until <= now]
            for i in late:
                del running[i]
            # What starts later is late later.
            wait = min(end, now + patience, *running.values()) - now
        for _ in late:
            threading.Thread(target=work, daemon=True).start()
        finished.wait(wait)
    with lock:
        taken = False
        return list(out)


def _in_batches(call: Callable, arguments: list[tuple], limits: Limits, longest: float | None = None) -> list[tuple[object, float | None]]:
    return [x for i in range(0, len(arguments), limits.rows) for x in answers(call, arguments[i : i + limits.rows], limits, longest)]


def merge_scores(df: DataFrame, scores: DataFrame, keys: list[str], column: str = "LLM_Similarity", retry: DataFrame | None = None) -> DataFrame:
    """`df` with the scores of its keys; nulls filled from the retry's scores."""
    out = df.join(scores.select(*keys, column), keys, "left")
    if retry is None:
        return out
    return out.join(retry.select(*keys, F.col(column).alias("__again")), keys, "left").withColumn(column, F.coalesce(column, "__again")).drop("__again")


def score_pairs(
    pairs: DataFrame, keys: list[str], score: Callable[[str, str], str | None], retry_rounds: int = 1, parallelism: int | None = None, column: str = "LLM_Similarity",
    limits: Limits = Limits(), retry_limits: Limits = Limits(at_once=20), report: list[Observation] | None = None,
) -> DataFrame:
    """`pairs` (keys, PDF_Description, Excel_Description) with the model's score: the first number of its answer.

    A call that fails or is late gives null; null rows are scored again, up to `retry_rounds` times. Each round's answers are written, so that no answered call repeats. `report` takes
    an observation of each round's write (see `scoring_summary`), so counts and latencies need no further job.
    """

    def round_of(limits: Limits) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = _in_batches(score, list(zip(batch["PDF_Description"], batch["Excel_Description"], strict=True)), limits)
                yield batch[keys].assign(answer=[None if a is None else str(a) for a, _ in found], seconds=pd.array([s for _, s in found], "Float64"))

        return ask

    def answered(rows: DataFrame, limits: Limits) -> DataFrame:
        kinds = dict(rows.dtypes)
        out = spread(rows, parallelism).mapInPandas(round_of(limits), ", ".join(f"{k} {kinds[k]}" for k in keys) + ", answer string, seconds double")
        out = out.select(*keys, F.when(F.col("answer").isNotNull(), first_number(F.col("answer"))).alias(column), "seconds")
        if report is not None:
            report.append(Observation())
            failed = F.col(column).isNull()
            out = out.observe(report[-1], F.count(F.lit(1)).alias("pairs"), F.count_if(failed).alias("failed"), F.count_if(F.col("seconds").isNull()).alias("late"), F.avg("seconds").alias("average_seconds"), F.max("seconds").alias("longest_seconds"))
        return store(out.drop("seconds"), "answers")

    asked = pairs.select(*keys, "PDF_Description", "Excel_Description")
    scores = answered(asked, limits)
    for _ in range(retry_rounds):
        failed = scores.filter(F.col(column).isNull()).select(*keys)
        if failed.isEmpty():
            break
        scores = merge_scores(scores.select(*keys), scores, keys, column, answered(asked.join(failed, keys, "left_semi"), retry_limits))
    return merge_scores(pairs, scores, keys, column)


def scoring_summary(spark: SparkSession, report: list[Observation]) -> DataFrame:
    """One row for each round: round, pairs, failed (no score), late (no answer in time), average_seconds and longest_seconds of the calls that returned in time."""
    rows = [(i + 1, *(o.get[k] for k in ("pairs", "failed", "late", "average_seconds", "longest_seconds"))) for i, o in enumerate(report)]
    return spark.createDataFrame(rows, "round int, pairs long, failed long, late long, average_seconds double, longest_seconds double")


def _retried(call: Callable, tries: Tries, has_result: Callable[[object], bool]) -> Callable:
    """`call` until it has a result, `tries.most` times in all; its last answer."""

    def run(*args):
        answer = None
        for i in range(tries.most):
            if i and (tries.delay or tries.jitter):
                time.sleep(tries.delay * tries.growth ** (i - 1) + random.uniform(0, tries.jitter))
            try:
                answer = call(*args)
                if has_result(answer):
                    return answer
            except Exception:  # noqa: BLE001  a model's failure is no result
                answer = None
        return answer

    return run


def _label(answer: object) -> int | None:
    return int(answer) if answer is not None and str(answer).strip().lstrip("-").isdigit() else None


def _has_items(answer: object) -> bool:
    """Whether an answer has any item; whether they are good is checked on the written answers."""
    try:
        return bool(json.loads(answer)["extracted_data"])
    except (TypeError, ValueError, KeyError):
        return False


def classify_images(images: DataFrame, classify: Callable[[str], str | None], rounds: int = 2, tries: Tries = Tries(), limits: Limits = Limits()) -> DataFrame:
    """`images` (image_name) with label, 1 to 3, and the number of the round that gave it; null where no round did.

    A round calls up to `tries.most` times until there is a label other than 0; images whose label isn't one of 1 to 3 are asked for in the next round. Each round is written.
    """

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = _retried(classify, tries, lambda a: bool(_label(a)))
        for batch in batches:
            labels = [_label(a) for a, _ in _in_batches(call, [(n,) for n in batch["image_name"]], limits, tries.longest(limits.call))]
            yield pd.DataFrame({"image_name": batch["image_name"], "label": pd.array([v if v in LABELS else None for v in labels], "Int32")})

    asked, out = images.select("image_name"), None
    for i in range(rounds):
        found = store(spread(asked).mapInPandas(ask, "image_name string, label int").withColumn("round", F.lit(i + 1)), "labels")
        out = found.filter("label IS NOT NULL") if out is None else out.union(found.filter("label IS NOT NULL"))
        left = found.filter("label IS NULL")
        asked = left.select("image_name")
        if left.isEmpty():
            break
    return out.union(left.withColumn("round", F.lit(None).cast("int")))


def extract_items(images: DataFrame, classify: Callable[[str], str | None], extract: Callable[[str, int], str | None], rounds: int = 2, tries: Tries = Tries(), limits: Limits = Limits()) -> DataFrame:
    """`images` (image_name) with stage (`done`, `classification` or `extraction`: where it failed), label and the raw items answer.

    A call that fails or answers without items is repeated up to `tries.most` times, with growing waits. Images whose parsed items are empty, or hold one with all fields empty, are asked
    for again, `rounds` times in all; each round's answers are written, so that no answered call repeats. What stays invalid failed in extraction.
    """

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = _retried(extract, tries, _has_items)
        for batch in batches:
            found = _in_batches(call, list(zip(batch["image_name"], map(int, batch["label"]), strict=True)), limits, tries.longest(limits.call))
            yield batch.assign(items_json=[a for a, _ in found])

    labelled = classify_images(images, classify, rounds, tries, limits).drop("round")
    asked, out = labelled.filter("label IS NOT NULL"), None
    for _ in range(rounds):
        found = spread(asked).mapInPandas(ask, "image_name string, label int, items_json string")
        found = found.withColumn("items", F.from_json("items_json", ITEMS)["extracted_data"]).withColumn("valid", F.coalesce(valid_items(), F.lit(False)))
        found = store(found.drop("items"), "answers")
        done = found.filter("valid")
        out = done if out is None else out.union(done)
        left = found.filter("NOT valid")
        asked = left.select("image_name", "label")
        if left.isEmpty():
            break
    failed = labelled.filter("label IS NULL").select("image_name", "label", F.lit(None).cast("string").alias("items_json"), F.lit("classification").alias("stage"))
    out = out.withColumn("stage", F.lit("done")).unionByName(left.withColumn("stage", F.lit("extraction"))).drop("valid")
    return out.unionByName(failed).select("image_name", "stage", "label", "items_json")


def extraction_summary(answers: DataFrame) -> DataFrame:
    """How many images were classified and extracted, and how many failed in either stage."""
    count = lambda cond, name: F.count_if(cond).alias(name)
    stage = F.col("stage")
    return answers.agg(count(stage != "classification", "classified"), count(stage == "classification", "classification_failed"), count(stage == "done", "extracted"), count(stage == "extraction", "extraction_failed"))

