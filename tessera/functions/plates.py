"""Plate text as columns: cleaning, layout, repair and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Province codes of the still-image rules, and those of the video rules.
PROVINCES = (
    "11 12 14 15 16 17 18 19 20 21 22 23 24 25 26 27 28 29 30 31 32 33 34 35 36 37 38 43 47 48 49 50 51 52 53 54 55 56 57 58 59 60 61 62 63 64 65 66 67 68 69 70 71 72 73 74 75 76 77 78 79 81 82 83 84 85 86 88 89 90 92 93 94 95 97 98 99"
).split()
VIDEO_PROVINCES = sorted([*PROVINCES, "40", "41", "80"])
# Characters that are read for one another, per rule set and wanted kind.
TO_NUMBER = ("OIJLGSZBQD", "0134652800")
TO_LETTER = ("0125864", "OIZSBGL")
VIDEO_TO_DIGIT = ("ODQUCILT/|JZSGBAFEH", "0000011111125684884")
VIDEO_TO_LETTER = ("06852147U", "DGBSZLATL")
# Lengths of a plate by vehicle kind.
LENGTHS = {"BIKE": (8, 9), "CAR": (7, 8), None: (7, 8, 9)}
# Patterns of made plates with their weights, and the letters used.
PATTERNS = (("##A#####", 0.6), ("##A####", 0.2), ("##AB###", 0.1), ("###A####", 0.05), ("##A##", 0.03), ("###A##", 0.02))
LETTERS = "ABCDEFGHKLMNPSTUVXYZ"


def clean(text: Column) -> Column:
    return F.regexp_replace(F.upper(text), "[^A-Z0-9]", "")


def as_number(c: Column) -> Column:
    return F.translate(F.upper(c), *TO_NUMBER)


def as_letter(c: Column) -> Column:
    return F.translate(F.upper(c), *TO_LETTER)


def layout(lines: Column) -> Column:
    """The vehicle kind of plate lines (an array of texts, top first)."""
    kept = F.filter(F.transform(lines, clean), lambda x: F.length(x) > 1)
    return F.when(F.size(kept) == 1, "CAR_RECT").when(F.size(kept) >= 2, F.when(F.length(F.get(kept, F.lit(0))) <= 3, "CAR_SQUARE").otherwise("BIKE")).otherwise("UNKNOWN")


def _lengths(kind: Column) -> Column:
    pack = lambda k: F.array(*[F.lit(x) for x in LENGTHS[k]])
    return F.when(kind == "BIKE", pack("BIKE")).when(kind.contains("CAR"), pack("CAR")).otherwise(pack(None))


def extract(text: Column, kind: Column) -> Column:
    """The text if its length suits the kind, else its longest window of such a length whose first
    two characters read as a province; of equals the first; else the text."""
    s, sizes = clean(text), _lengths(kind)
    windows = F.flatten(F.transform(sizes, lambda n: F.when(n <= F.length(s), F.transform(F.sequence(F.lit(1), F.length(s) - n + 1), lambda i: F.substring(s, i, n))).otherwise(F.array().cast("array<string>"))))
    good = F.filter(windows, lambda x: as_number(F.substring(x, 1, 2)).isin(PROVINCES))
    most = F.array_max(F.transform(good, F.length))
    best = F.get(F.filter(good, lambda x: F.length(x) == most), F.lit(0))
    return F.when(F.array_contains(sizes, F.length(s)), s).otherwise(F.coalesce(best, s))


def validate(text: Column, kind: Column) -> Column:
    """struct(valid, text) of one reading; for a table, validated() works each step out once."""
    s = extract(text, kind)
    fits = F.array_contains(_lengths(kind), F.length(s))
    fixed = _formed(s)
    return F.struct((fits & F.substring(fixed, 1, 2).isin(PROVINCES)).alias("valid"), F.when(fits, fixed).otherwise(s).alias("text"))


def _formed(s: Column) -> Column:
    return F.concat(as_number(F.substring(s, 1, 2)), as_letter(F.substring(s, 3, 1)), as_number(F.substring(s, F.lit(4), F.length(s))))


def validated(rows: DataFrame, text: str = "text", kind: str = "kind") -> DataFrame:
    """Adds valid, and replaces text by its repair: two digits, a letter, digits; with a province that
    exists. What is extracted stands as a column, so its windows are built once a row."""
    rows = rows.withColumn("__s", extract(F.col(text), F.col(kind)))
    fits = F.array_contains(_lengths(F.col(kind)), F.length("__s"))
    rows = rows.withColumn("__f", F.when(fits, _formed(F.col("__s"))))
    return rows.withColumn("valid", F.coalesce(F.substring("__f", 1, 2).isin(PROVINCES), F.lit(False))).withColumn(text, F.coalesce("__f", "__s")).drop("__s", "__f")


def nearest_province(code: Column) -> Column:
    """Of the codes that share a character with this one, the greatest; null if there is none.

    For two characters that is the closest match by the ratio of matching blocks, ties to the
    greatest.
    """
    codes = F.array(*[F.lit(p) for p in VIDEO_PROVINCES])
    return F.array_max(F.filter(codes, lambda p: p.contains(F.substring(code, 1, 1)) | p.contains(F.substring(code, 2, 1))))


def smart_correct(text: Column) -> Column:
    """The video rules' repair; null where the length is not 7 to 10."""
    s = clean(text)
    digit = lambda x: F.translate(x, *VIDEO_TO_DIGIT)
    code = digit(F.substring(s, 1, 2))
    code = F.when(code.isin(VIDEO_PROVINCES), code).otherwise(F.coalesce(nearest_province(code), code))
    third = F.translate(F.translate(F.substring(s, 3, 1), *VIDEO_TO_LETTER), "U0O", "LDD")
    fourth = F.translate(F.substring(s, 4, 1), "U", "L")
    rest = F.when(F.length(s) >= 8, F.concat(fourth, digit(F.substring(s, F.lit(5), F.length(s))))).otherwise(digit(F.substring(s, F.lit(4), F.length(s))))
    return F.when(F.length(s).between(7, 10), F.concat(code, third, rest))


def display(text: Column) -> Column:
    n = F.length(text)
    cut = lambda k: F.concat(F.substring(text, 1, k), F.lit("-"), F.substring(text, F.lit(k + 1), n))
    return F.when(n >= 8, cut(4)).when(n == 7, cut(3)).otherwise(text)


# Forms of plates.
FORMATS = (("car", "[0-9]{2}[A-Z][0-9]{4,5}"), ("bike", "[0-9]{2}[A-Z][A-Z0-9][0-9]{4,5}"), ("special", "[0-9]{2}[A-Z]{2}[0-9]{3,5}"))


def format_of(text: Column) -> Column:
    """The first form that the whole text has, else none."""
    out = None
    for name, pattern in FORMATS:
        hit = F.regexp_like(text, F.lit(f"^(?:{pattern})$"))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("none")


def read_scale(height: Column) -> Column:
    """How many times a crop of so many rows is enlarged before it is read."""
    return F.when(height < 64, 3).when(height < 128, 2).otherwise(1)
