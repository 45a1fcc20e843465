"""Language models as an operator over prompt rows.

A backend is any object with ``ask(prompt, system, **options) -> str | None``;
it is made once a partition by a factory that the executors can import or
unpickle. Failures give a null answer and never fail the job.
"""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.batches import slices

#: Sampling options of the three users: (temperature, answer tokens).
OPTIONS = {"batch": (0.1, 1024), "tagger": (0.05, 1500), "summariser": (0.1, 600)}


class HttpBackend:
    """A generate endpoint that takes model, prompt, system and options and answers in one piece."""

    def __init__(self, url: str, model: str, timeout: float = 300):
        self.url, self.model, self.timeout = url, model, timeout

    def ask(self, prompt: str, system: str = "", temperature: float = 0.1, tokens: int = 1024) -> str | None:
        import urllib.request

        body = {"model": self.model, "prompt": prompt, "system": system, "stream": False, "options": {"temperature": temperature, "num_predict": tokens}}
        request = urllib.request.Request(self.url, json.dumps(body).encode(), {"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                return json.load(answer).get("response", "").strip()
        except (OSError, ValueError):
            return None


class RecordedBackend:
    """Answers kept by prompt; unknown prompts get none."""

    def __init__(self, answers: dict[str, str]):
        self.answers = answers

    def ask(self, prompt: str, system: str = "", **_) -> str | None:
        return self.answers.get(prompt)


class RuleBackend:
    """Answers computed from the prompt, for tests and dry runs."""

    def __init__(self, rule: Callable[[str], str | None]):
        self.rule = rule

    def ask(self, prompt: str, system: str = "", **_) -> str | None:
        return self.rule(prompt)


def once(df: DataFrame) -> DataFrame:
    """``df`` computed and kept in the cluster's checkpoint folder, so that no model is asked twice.

    The folder is the session's; one of our own serves only where none is set.
    """
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(folder or "file://" + os.path.join(tempfile.gettempdir(), "lexiforge-shared"))
    return df.checkpoint()


def ask(prompts: DataFrame, backend: Callable[[], object], system: str = "", user: str = "batch", column: str = "prompt", keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """``keys`` and ``answer`` for each prompt. Spread the rows first if the model serves many at a time."""
    temperature, tokens = OPTIONS[user]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in slices(batches):
            model = model or backend()
            answers = [None if p is None else model.ask(p, system, temperature=temperature, tokens=tokens) for p in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(answers, pa.string())], names=[*batch.schema.names[:-1], "answer"])

    rows = prompts.select(*keys, F.col(column).alias("__prompt"))
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return once(rows.mapInArrow(run, f"{kind}, answer string"))
