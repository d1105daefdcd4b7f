"""Small tables with the awkward rows that every operator has to bear."""

from __future__ import annotations

from pathlib import Path

DATA = "/root/testdata"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as further columns of the input.
CLASHING = ", score double, label int, block long, anchor long, component_id long, shard string, found array<int>, value long, first int, _first int"
CLASHES = (0.5, 1, 2, 3, 4, "x", [1], 5, 6, 7)


def store(spark, folder: Path, **tables) -> str:
    """Writes tables, given as (rows, schema), as Parquet and returns the folder."""
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def documents(texts: list[str | None], clashing: bool = True) -> tuple[list, str]:
    rows = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    if clashing:
        return [(*r, *CLASHES) for r in rows], DOCUMENTS + CLASHING
    return rows, DOCUMENTS


AWKWARD = [
    None,
    "",
    " \t\n",
    "a",
    "été über naïve 日本語 🎉🎉",
    "<|endoftext|>",
    "x<|endoftext|>y  \n\n z<|endoftext|>",
    "don't we'll  go\t\t now 123,456!!!??",
    "word " * 3000,
    "q" * 5000,
    "same text in two rows of the table",
    "same text in two rows of the table",
    " " * 700 + "end",
    "\x00 control \x0b bytes \x7f",
]
