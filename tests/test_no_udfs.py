"""The analytics library stays JVM-side: no Python UDFs, pandas UDFs or RDD per-row code in kredo/ (llm/ apart)."""

import pathlib
import re

FORBIDDEN = re.compile(r"\b(udf|pandas_udf|mapInPandas|applyInPandas|mapPartitions|localCheckpoint)\b|\.rdd\.map")


def test_no_python_row_code_in_the_library():
    root = pathlib.Path(__file__).resolve().parent.parent / "kredo"
    hits = []
    for p in root.rglob("*.py"):
        if "llm" in p.relative_to(root).parts:
            continue
        for n, line in enumerate(p.read_text().splitlines(), 1):
            code = line.split("#", 1)[0]
            if FORBIDDEN.search(code):
                hits.append(f"{p.name}:{n}: {line.strip()}")
    assert hits == []
