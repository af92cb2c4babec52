"""The SQL of the licence scan on rows that the driver's tables lack: wrapped, commented and tagged sentences."""

import random
import textwrap

import duckdb
import pandas as pd

from lumentab.llm import licenses


def test_sql_agrees_on_wrapped_and_tagged_sentences(spark):
    rng = random.Random(1)
    known = [s for own in licenses.SENTENCES.values() for s in own]
    rows = [(900, None), (901, ""), (902, "\n\n"), (903, "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: Apache-2.0")]
    for i in range(400):
        parts = [rng.choice(known) if rng.random() < 0.7 else f"some other words {i}" for _ in range(rng.randint(1, 5))]
        text = rng.choice([". ", "\n", "\n\n", "; ", ".\r\n", " "]).join(parts)
        if rng.random() < 0.6:
            text = "\n".join(textwrap.wrap(text, rng.choice([30, 72])))
        if rng.random() < 0.3:
            text = "\n".join(rng.choice(["# ", "// ", " * "]) + x for x in text.split("\n"))
        rows.append((i, text))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    want = con.sql(licenses.oracle())
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    order = [want.columns.index(c) for c in columns]
    told = sorted(tuple(r[c] for c in columns) for r in got.collect())
    assert told == sorted(tuple(r[k] for k in order) for r in want.fetchall())
    assert sum(r[columns.index("n_known")] > 0 for r in told) > 200
