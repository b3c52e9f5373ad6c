"""Recall and precision of text repair on texts that are garbled here: python -m tests.llm.measure_repair FOLDER [SEED].

Documents in which the operator finds nothing are taken as clean.  A part of those with characters
beyond ASCII is written in one encoding and read in another (whole or from some line on, once or
twice, with bytes that mean nothing dropped or replaced); the operator then sees the whole table.
No constant of the operator was set on these texts.
"""

from __future__ import annotations

import random
import sys
from collections import Counter, defaultdict

#: written in, read in.
WAYS = [("utf-8", r) for r in ("cp1252", "latin-1", "cp1250", "iso8859-15", "cp1251", "koi8-r", "cp437", "cp850", "cp866", "mac-roman", "cp1253", "gb18030", "shift_jis")]
WAYS += [("cp1252", "mac-roman"), ("mac-roman", "cp1252"), ("cp1252", "cp437"), ("cp850", "cp1252"), ("cp1251", "cp1252"), ("koi8-r", "cp1251"), ("cp1251", "koi8-r"), ("latin-1", "utf-8"), ("cp1252", "cp1251")]


def garble(text: str, rng: random.Random) -> tuple[str, str] | None:
    written, read = rng.choice(WAYS)
    how = rng.choice(["whole", "whole", "part", "twice", "dropped"])
    head, body = "", text
    if how == "part":
        lines = text.splitlines(keepends=True)
        at = rng.randrange(len(lines))
        head, body = "".join(lines[:at]), "".join(lines[at:])
    for _ in range(2 if how == "twice" else 1):
        try:
            body = body.encode(written).decode(read, "ignore" if how == "dropped" else "replace")
        except UnicodeEncodeError:
            return None
    return (head + body, f"{written} as {read}{' twice' if how == 'twice' else ''}") if head + body != text else None


def main(folder: str, seed: int = 1) -> None:
    from pyspark.sql import SparkSession

    from labelmill.llm.mojibake import repair_texts

    spark = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    bad = {r[0] for r in repair_texts(documents, "text", ["doc_id"]).filter("garbled").select("doc_id").collect()}
    rng, rows, true, copies = random.Random(seed), [], {}, Counter()
    for doc_id, text in documents.collect():
        if doc_id in bad:
            continue
        made = garble(text, rng) if text and not text.isascii() and rng.random() < 0.08 else None
        if made:
            true[doc_id] = (text, made[1])
        rows.append((doc_id, made[0] if made else text))
        copies[text] += 1
    got = {r["doc_id"]: r for r in repair_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), "text", ["doc_id"]).filter("garbled").collect()}
    by = defaultdict(Counter)
    for doc_id, (text, way) in true.items():
        by[way].update(n=1, found=int(doc_id in got), restored=int(doc_id in got and got[doc_id]["restored"] == text))
    for way, c in sorted(by.items()):
        print(f"{way}: {c['n']} garbled, {c['found']} found, {c['restored']} restored exactly")
    hit = sum(d in got for d in true)
    print(f"seed {seed}: {len(rows)} documents, {len(true)} garbled, {hit} found (recall {hit / len(true):.4f}), {len(got) - hit} others (precision {hit / max(1, len(got)):.4f}), {sum(c['restored'] for c in by.values())} restored exactly")
    wrong = sum(got[d]["complete"] and got[d]["restored"] != true[d][0] for d in true if d in got)
    print(f"called complete though the text differs: {wrong}")


if __name__ == "__main__":
    main(sys.argv[1], *map(int, sys.argv[2:]))
