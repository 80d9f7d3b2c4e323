"""Writers: label text, review folders, lineage, reports, dataset descriptions. Bytes of images are never
moved: a manifest says what goes where."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dataset import write_files
from .labels import render


def label_files(boxes: DataFrame, class_id: Column | None = None, conf: Column | None = None) -> DataFrame:
    """split, stem, text: the lines of each label file in order of line_no (class 0 unless given)."""
    line = render(F.lit(0) if class_id is None else class_id, *[F.col(c) for c in ("xc", "yc", "w", "h")], conf)
    files = boxes.select("split", "stem", F.struct("line_no", line.alias("line")).alias("l")).groupBy("split", "stem").agg(F.array_sort(F.collect_list("l")).alias("l"))
    return files.select("split", "stem", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("text"))


def write_label_files(files: DataFrame, path: str) -> None:
    """One text file per label file, named by its stem, in a folder per split, in any store that driver and
    executors reach."""
    write_files(files.select(F.concat("split", F.lit("/"), "stem", F.lit(".txt")).alias("path"), F.concat("text", F.lit("\n")).alias("content")), path)


def copy_manifest(files: DataFrame, root: str, link: Column | None = None) -> DataFrame:
    """path, target, action (copy or symlink) for an external copier."""
    action = F.lit("copy") if link is None else F.when(link, "symlink").otherwise("copy")
    return files.select("path", F.concat_ws("/", F.lit(root), F.lit("images"), "split", "name").alias("target"), action.alias("action"))


def write_review(flagged: DataFrame, path: str, category: str = "category") -> None:
    """Flagged items as JSON, in a folder per category."""
    flagged.write.mode("overwrite").partitionBy(category).json(path)


def write_mapping(rows: DataFrame, path: str) -> None:
    """Lineage as CSV with a header."""
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)


def data_yaml(splits: DataFrame, root: str, names: list[str]) -> str:
    """The dataset description; splits has one row a split."""
    found = {r[0] for r in splits.select("split").distinct().collect()}  # a handful
    lines = [f"path: {root}", *[f"{s}: images/{s}" for s in ("train", "val", "test") if s in found], f"nc: {len(names)}", "names:", *[f"  {i}: {n}" for i, n in enumerate(names)]]
    return "\n".join(lines) + "\n"


def fixed_files(parsed: DataFrame, line: Column) -> DataFrame:
    """split, stem, text: each label file's lines as rewritten (null ones left out), in order of line_no;
    the original text where no line is rewritten."""
    l = F.struct("line_no", line.alias("new"), F.col("line").alias("old"))
    files = parsed.groupBy("split", "stem").agg(F.array_sort(F.collect_list(l)).alias("l"))
    new = F.filter(F.transform("l", lambda x: x["new"]), lambda x: x.isNotNull())
    text = F.when(F.size(new) > 0, F.array_join(new, "\n")).otherwise(F.array_join(F.transform("l", lambda x: x["old"]), "\n"))
    return files.select("split", "stem", text.alias("text"))


def descriptions(splits: DataFrame, root: str, names: list[str]) -> DataFrame:
    """variant, text: the dataset description with names as a map, as a list, and as JSON."""
    place = F.when(F.col("split") == "train", 0).when(F.col("split") == "val", 1).otherwise(2)
    found = splits.select("split").distinct().agg(F.array_sort(F.collect_list(F.struct(place.alias("k"), "split"))).alias("s"))
    join = lambda form, sep: F.array_join(F.transform("s", lambda x: F.format_string(form, x["split"], x["split"])), sep)
    head = F.concat(F.lit(f"path: {root}\n"), join("%s: images/%s", "\n"), F.lit(f"\nnc: {len(names)}\n"))
    forms = {
        "map": F.concat(head, F.lit("names:\n" + "".join(f"  {i}: {n}\n" for i, n in enumerate(names)))),
        "list": F.concat(head, F.lit(f"names: [{', '.join(names)}]\n")),
        "json": F.concat(F.lit(f'{{"path":"{root}",'), join('"%s":"images/%s"', ","), F.lit(f',"nc":{len(names)},"names":[' + ",".join(f'"{n}"' for n in names) + "]}")),
    }
    return found.select(F.explode(F.array(*[F.struct(F.lit(k).alias("variant"), v.alias("text")) for k, v in forms.items()])).alias("d")).select("d.*")
