"""Calling models from Spark tasks (M1, M2, M9).

A model is a callable ``client(model_id, payload, policy) -> dict`` made by
``make_client()`` inside the task, nothing captured from the driver. A task has
a bounded number of calls in flight, each by a client of its own thread. A
retried task calls again, so callers write the result of ``invoke`` to a stage
table before anything else reads it; ``call_once`` does so in slices, and calls
for equal requests once.
"""

from __future__ import annotations

import hashlib
import json
import random
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.operators.joins import join_unique
from paperloom.staging import COMMIT_BY_TASK, scratch_path, stage

Client = Callable[[str, dict, tuple[str, str] | None], dict]


class ServiceError(Exception):
    """What a client raises when the model service refuses a call."""

    def __init__(self, code: str, message: str):
        super().__init__(code, message)
        self.code, self.message = code, message


# Calls of one task that wait for their answer at a time.
IN_FLIGHT = 8
# Calls made between two commits, about.
SLICE_CALLS = 100_000


@dataclass(frozen=True)
class Retry:
    """Which refusals are tried again: so many tries in all, waiting longer each time.

    A wait is drawn between half and all of ``first * factor ** n`` seconds, so
    that calls refused together do not come back together.
    """

    codes: tuple[str, ...] = ("ThrottlingException", "ServiceUnavailableException", "ModelTimeoutException", "InternalServerException")
    tries: int = 4
    first: float = 0.5
    factor: float = 2.0

    def wait(self, tried: int) -> float:
        return self.first * self.factor ** (tried - 1) * (0.5 + random.random() / 2)


RESULT_FIELDS = [
    T.StructField("response", T.StringType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("ok", T.BooleanType(), False),
    T.StructField("error_code", T.StringType()),
    T.StructField("error_message", T.StringType()),
]


def invoke(
    df: DataFrame,
    make_client: Callable[[], Client],
    on_error: str = "fail",
    default_model: str = "stub",
    parallel: int | None = None,
    in_flight: int = IN_FLIGHT,
    retry: Retry | None = None,
) -> DataFrame:
    """M1, M9: add the response body and the seconds around each call.

    Reads ``payload`` (JSON) and, where present, ``model_id``, ``policy_id``
    and ``policy_version``. A row without payload is not sent. With ``on_error="fail"`` a service error ends the
    job with code and message; with ``"column"`` it is a row with ``ok`` false.

    Calls are dealt over ``parallel`` tasks, by default one for each core: a
    call takes far longer than its row is large, so tasks are not made by bytes.
    Of each task ``in_flight`` calls wait at a time. ``retry`` says which errors
    are tried again; seconds are those of the last try.
    """
    if on_error not in ("fail", "column"):
        raise ValueError(f"on_error is fail or column, not {on_error}")
    if in_flight < 1:
        raise ValueError("at least one call is in flight")
    schema = T.StructType(df.schema.fields + RESULT_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = threading.local()

        def call(args: tuple) -> tuple:
            if not hasattr(own, "client"):
                own.client = make_client()
            return _call(own.client, *args, on_error, retry)

        with ThreadPoolExecutor(in_flight) as pool:
            for batch in batches:
                n, names = batch.num_rows, batch.schema.names

                def values(name: str, default: str | None = None) -> list:
                    return batch.column(name).to_pylist() if name in names else [default] * n

                asked = zip(values("model_id", default_model), values("payload"), values("policy_id"), values("policy_version"))
                results = _in_flight(pool, call, asked, in_flight)
                bodies, seconds, oks, codes, messages = zip(*results) if results else ((),) * 5
                added = [
                    pa.array(bodies, pa.string()),
                    pa.array(seconds, pa.float64()),
                    pa.array(oks, pa.bool_()),
                    pa.array(codes, pa.string()),
                    pa.array(messages, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*names, *[f.name for f in RESULT_FIELDS]])

    return df.repartition(parallel or df.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, schema)


def _in_flight(pool: ThreadPoolExecutor, call: Callable[[tuple], tuple], asked: Iterator[tuple], at_once: int) -> list[tuple]:
    """Results in the order of the calls: ``at_once`` threads each take the next call when they are done with one."""
    taking, numbered, results, failed = threading.Lock(), enumerate(asked), {}, threading.Event()

    def work() -> None:
        while not failed.is_set():  # after an error no further call is made
            with taking:
                number, args = next(numbered, (None, None))
            if number is None:
                return
            try:
                results[number] = call(args)
            except BaseException:
                failed.set()
                raise

    for done in [pool.submit(work) for _ in range(at_once)]:
        done.result()
    return [results[number] for number in range(len(results))]


def _call(
    client: Client, model_id: str, payload: str | None, policy_id: str | None, policy_version: str | None, on_error: str, retry: Retry | None = None
) -> tuple:
    if payload is None:
        return None, None, False, "NoPayload", "nothing to send"
    policy = (policy_id, policy_version) if policy_id and policy_version else None
    tried = 0
    while True:
        started = time.perf_counter()
        tried += 1
        try:
            body = json.dumps(client(model_id, json.loads(payload), policy), ensure_ascii=False)
            return body, round(time.perf_counter() - started, 6), True, None, None
        except ServiceError as e:
            if retry is not None and e.code in retry.codes and tried < retry.tries:
                time.sleep(retry.wait(tried))
                continue
            if on_error == "fail":
                raise RuntimeError(f"model invocation failed: {e.code} - {e.message}") from e
            return None, round(time.perf_counter() - started, 6), False, e.code, e.message


REQUEST = ["model_id", "payload", "policy_id", "policy_version"]


def call_digest(columns: list[str], key: str | None = None) -> Column:
    """What makes two requests the same call: all that is sent, and the ``key``, if there is one."""

    def part(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    told = [part(c) if c in columns else F.lit("-") for c in REQUEST] + ([part(key)] if key else [])
    return F.sha2(F.concat(*told).cast("binary"), 256)


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def call_once(
    requests: DataFrame,
    make_client: Callable[[], Client],
    folder: str,
    key: str | None = None,
    slice_calls: int = SLICE_CALLS,
    parallel: int | None = None,
    in_flight: int = IN_FLIGHT,
    retry: Retry | None = None,
) -> DataFrame:
    """M1: ``requests`` with their outcome; equal requests are one call, and calls with an answer in ``folder`` are not made.

    Outcomes are kept in ``folder`` by a digest of all that is sent, so a
    changed text, prompt, setting or model is another call. With ``key`` rows
    that differ in that column have calls of their own. Outcomes are committed
    in slices of about ``slice_calls`` calls: a task calls for a slice and commits
    it by itself, so one job serves any number of slices, what a broken run has
    committed is not called again, and a lost executor repeats the slices it was
    at. With ``parallel`` a job has no more tasks than that, and there are as many
    jobs as the slices need. A request without payload is not sent. Errors are kept, and tried again by the
    next run.
    """
    spark, path = requests.sparkSession, folder.rstrip("/")
    sent = [c for c in REQUEST if c in requests.columns]
    keyed = requests.withColumn("_call", F.when(F.col("payload").isNotNull(), call_digest(sent, key)))
    outcome = ["response", "seconds", "ok", "error_code", "error_message"]
    schema = T.StructType([T.StructField("_call", T.StringType()), *RESULT_FIELDS])
    asked = keyed.filter("_call IS NOT NULL").select("_call", *sent).dropDuplicates(["_call"])
    if _exists(spark, path):
        finished = spark.read.schema(schema).parquet(path).filter("ok").select("_call")
        asked = asked.join(finished, "_call", "left_anti")
    todo = stage(asked, "calls")
    n, tasks = todo.count(), parallel or spark.sparkContext.defaultParallelism
    slices = max(1, -(-n // slice_calls))
    # where tasks are limited, a job has so many slices and no more
    jobs = -(-slices // tasks) if parallel else 1
    if jobs > 1:
        dealt = todo.withColumn("_job", F.pmod(F.xxhash64("_call"), F.lit(jobs)).cast("int"))
        parts = scratch_path(spark, "call-slices")
        dealt.repartition(jobs, "_job").write.partitionBy("_job").parquet(parts)
        todo = spark.read.schema(dealt.schema).parquet(parts)
    for job in range(jobs):
        part = todo.filter(F.col("_job") == job).drop("_job") if jobs > 1 else todo
        made = invoke(part, make_client, "column", parallel=tasks if parallel else max(tasks, slices), in_flight=in_flight, retry=retry)
        made.select("_call", *outcome).write.mode("append").option(*COMMIT_BY_TASK).parquet(path)
    # of several tries the one that succeeded stands
    known = spark.read.schema(schema).parquet(path).groupBy("_call").agg(F.max_by(F.struct(*outcome), F.col("ok")).alias("_o"))
    joined = join_unique(keyed, known, ["_call"])
    unsent = {"ok": F.lit(False), "error_code": F.lit("NoPayload"), "error_message": F.lit("nothing to send")}
    result = [F.when(F.col("_call").isNull(), unsent[c]).otherwise(F.col(f"_o.{c}")).alias(c) if c in unsent else F.col(f"_o.{c}").alias(c) for c in outcome]
    return joined.select(*requests.columns, *result)


def prompt_of(payload: dict) -> str:
    """The user prompt inside a payload of any style."""
    if "prompt" in payload:
        return payload["prompt"]
    return payload["messages"][0]["content"][0]["text"]


def digest(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def make_stub() -> Client:
    """A deterministic stand-in. Its judges' verdicts follow from all they are
    given, by a digest; to anything else it says the whole prompt."""

    def client(model_id: str, payload: dict, policy: tuple[str, str] | None) -> dict:
        prompt = prompt_of(payload)
        seen = digest(prompt)
        number = int(seen[:4], 16)
        if prompt.endswith("list any inaccuracies."):
            text = f"Score: {number % 101 / 100:.2f}\n- read {seen}"
        elif prompt.startswith("Evaluate the summary"):
            marks = {"clarity": number % 6, "completeness": {"score": number // 6 % 6, "justification": seen}, "overall": number % 11 / 2}
            text = "Result: " + json.dumps(marks)
        else:
            text = f"[{model_id}] " + prompt.strip(" \n")
        return {"content": [{"type": "text", "text": text}], "completion": text}

    return client
