"""Model completions through an injected client (SRC-11, ST-03, ST-07): failures become columns, never exceptions."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.replies import canonical_json
from ..plans.extraction import first_json_object

SCHEMA = "key long, reply string, attempts int, error string"
REPAIR = "\n\nYour last answer was not valid JSON. Answer with one JSON object only."


def completions(prompts: DataFrame, make_client: Callable[[], Callable[[str], str]], attempts: int = 3) -> DataFrame:
    """prompts(key, prompt) -> (key, reply, attempts, error).

    make_client is called once a task and gives a function from prompt to text. A reply that holds no JSON object is
    asked for again with a repair note, a failed call again as it was, attempts times at most.
    """

    def ask(client: Callable[[str], str], prompt: str) -> tuple[str | None, int, str | None]:
        error, asked = None, prompt
        for n in range(1, attempts + 1):
            try:
                found = first_json_object(client(asked))
            except Exception as e:  # a client may fail in any way; the row says so
                error = f"{type(e).__name__}: {e}"
                continue
            if found is not None:
                return canonical_json(found), n, None
            error, asked = "no JSON object", prompt + REPAIR
        return None, attempts, error

    def run(batches):
        client = make_client()
        for batch in batches:
            rows = [ask(client, p or "") for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.string())], ["key", "reply", "attempts", "error"])

    return prompts.select(F.col("key").cast("long").alias("key"), F.col("prompt").cast("string").alias("prompt")).mapInArrow(run, SCHEMA)


class RecordedClient:
    """A client that answers by what a prompt asks for, as recorded: at once, after a repair note, never, or not at all."""

    def __init__(self) -> None:
        self.seen: dict[str, int] = {}

    def __call__(self, prompt: str) -> str:
        task = prompt.split("\n")[0]
        self.seen[task] = self.seen.get(task, 0) + 1
        kind, _, number = task.partition(" ")
        if kind == "busy" and self.seen[task] < 3 or kind == "down":
            raise ConnectionError("try later")
        if kind == "prose" or kind == "repair" and not prompt.endswith(REPAIR):
            return "I would rather explain"
        return f'Here: {{"n": {number}, "kind": "{kind}"}}'


def pending(prompts: DataFrame, done: DataFrame, version: str, tasks: tuple[str, ...]) -> DataFrame:
    """Prompts whose key has not succeeded in every task at this version: done(key, task, version, status) (ST-01)."""
    ok = done.filter((F.col("version") == version) & (F.col("status") == "success") & F.col("task").isin(*tasks))
    finished = ok.groupBy("key").agg(F.countDistinct("task").alias("n")).filter(F.col("n") == len(tasks))
    return prompts.join(finished, "key", "left_anti")
