"""JSON profile: every path of a corpus with the types seen there."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LONG = 1 << 63


def _type_name(v: object) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, int):
        return "int" if -_LONG <= v < _LONG else "float"
    return {float: "float", str: "str", list: "list", dict: "dict"}[type(v)]


def document_paths(doc: object, array_sample: int) -> Iterator[tuple[str, str]]:
    """(path, type) of every value of a document; of an array the first items only."""
    open_ = [("", doc)]
    while open_:
        path, v = open_.pop()
        yield path or "<root>", _type_name(v)
        if isinstance(v, dict):
            open_ += [(f"{path}.{k}" if path else k, item) for k, item in v.items()]
        elif isinstance(v, list):
            open_ += [(f"{path}[]", item) for item in v[:array_sample]]


def path_types(docs: DataFrame, payload: str = "payload", array_sample: int = 5, held: int = 100_000) -> DataFrame:
    """``(path, types)`` over all documents, at any depth: types sorted, arrays sampled to their first items.

    One scan and one shuffle. A task walks its documents and lets each (path, type) out once, or again after ``held`` others, so what is shuffled is about as
    large as the profile. Documents that are NULL have no path.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, str]] = set()
        for batch in batches:
            found: list[tuple[str, str]] = []
            for text in batch.column(0).to_pylist():
                for pair in document_paths(json.loads(text), array_sample):
                    if pair not in seen:
                        seen.add(pair)
                        found.append(pair)
                if len(seen) > held:
                    seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.string()) for k in (0, 1)], names=["path", "type"])

    texts = docs.where(F.col(payload).isNotNull()).select(F.to_json(F.col(payload)).alias("doc"))
    return texts.mapInArrow(run, "path string, type string").groupBy("path").agg(F.array_sort(F.collect_set("type")).alias("types"))
