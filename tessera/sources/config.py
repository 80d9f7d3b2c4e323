"""Configuration files and reports."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _scalar(text: str):
    text = text.strip()
    if text[:1] in "\"'" and text[-1:] == text[:1] and len(text) > 1:
        return text[1:-1]
    if text.startswith("[") and text.endswith("]"):
        return [_scalar(x) for x in text[1:-1].split(",")] if text[1:-1].strip() else []
    known = {"": None, "null": None, "~": None, "true": True, "false": False}
    if text.lower() in known:
        return known[text.lower()]
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def parse_yaml(text: str):
    """The part of YAML that dataset and training configurations use: nested maps, lists of scalars in
    either form, scalars, comments. JSON is read too. Raises ValueError for a line that is neither."""
    if text.lstrip()[:1] in "{[" and text.strip():
        return json.loads(text)
    root: dict = {}
    levels: list[tuple[int, dict, str | None]] = [(-1, root, None)]
    for number, raw in enumerate(text.splitlines(), 1):
        line = raw.split(" #")[0].rstrip() if not raw.lstrip().startswith("#") else ""
        if not line.strip() or line.strip() == "---":
            continue
        depth, line = len(line) - len(line.lstrip()), line.strip()
        if line.startswith("- "):
            while levels[-1][0] > depth or levels[-1][2] is None:
                levels.pop()
                if not levels:
                    raise ValueError(f"line {number}: a list without a key")
            _, owner, key = levels[-1]
            if not isinstance(owner[key], list):
                owner[key] = []
            owner[key].append(_scalar(line[2:]))
            continue
        key, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"line {number}: no key")
        while levels[-1][0] >= depth:
            levels.pop()
        _, owner, last = levels[-1]
        if last is not None:
            if not isinstance(owner[last], dict):
                owner[last] = {}
            owner = owner[last]
        key = str(_scalar(key))
        owner[key] = _scalar(value)
        levels.append((depth, owner, key))
    return root


def tidy(reports: DataFrame, report: str) -> DataFrame:
    """section, stat, value (text) of reports that are JSON objects of objects, a text each."""
    sections = reports.select(F.explode(F.from_json(report, "map<string,map<string,string>>")).alias("section", "stats"))
    return sections.select("section", F.explode("stats").alias("stat", "value"))


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """All JSON reports below path, tidy."""
    return tidy(spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json"), "value")


def first_of(metrics: Column, *names: str, default: float | None = 0.0) -> Column:
    """A number from a map of texts, by the first of the names that it has and that reads."""
    return F.coalesce(*[F.get(F.array(metrics[n]), F.lit(0)).try_cast("double") for n in names], F.lit(default).cast("double"))
