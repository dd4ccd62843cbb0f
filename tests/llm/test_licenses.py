import re

import pytest

from curbline.llm import licenses

SCHEMA = "doc_id long, text string, row int, family string"
LINES = {
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0": "Apache-2.0",
    "this work is LICENSED under the GNU General Public License, version 3": "GPL-3.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
    "All rights reserved.": "Proprietary",
    "Code is released under the MIT license, enjoy": "MIT",
}
PLAIN = ["The work of the people is version of this.", "A license to the public", "no rights", "Apache tribes", "cc"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, f"Some words here about the house {n}\nand the garden of it", 1, "f") for n in range(300)]
    for line in LINES:
        rows.append((len(rows), f"Words before\n{line}\nwords after", 1, "f"))
    for line in PLAIN:
        rows.append((len(rows), f"Words before\r\n{line}\r\nwords after", 1, "f"))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def model(docs):
    return licenses.fit(docs)


def brute_score(line, model):
    """Logits of one line, term by term."""
    words = [w for w in re.split(r"[^\w]+|_", line.lower()) if w]
    grams = [w for w in words if w in model["anchors"]]
    grams += [f"{a} {b}" for a, b in zip(words, words[1:]) if a in model["anchors"] or b in model["anchors"]]
    return [
        x + sum(model["weights"][g][n] for g in grams if g in model["weights"])
        for n, x in enumerate(model["intercepts"])
    ]


def test_families_are_found_and_plain_text_is_unknown(spark, docs, model):
    rows = {r.doc_id: r for r in licenses.scan(docs, model).collect()}
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for doc_id, row in rows.items():
        lines = re.split(r"\r\n|\n", texts[doc_id])
        wanted = next((LINES[line] for line in lines if line in LINES), "unknown")
        assert row.family == wanted, texts[doc_id]
        assert (row.paragraph == 1 and row.score >= 0.5) if wanted != "unknown" else row.score is None


def test_scores_equal_brute_force(spark, model):
    lines = [*LINES, *PLAIN, "nothing at all", ""]
    frame = spark.createDataFrame(list(enumerate(lines)), "n int, line string")
    grams = frame.select("n", licenses.features(licenses.words(licenses.F.col("line")), model["anchors"]).alias("grams"))
    for row in licenses.classified(grams, model, ["n"]).collect():
        logits = brute_score(lines[row.n], model)
        best = max(range(len(logits) - 1), key=lambda k: (logits[k], model["families"][k]))
        assert row.margin == pytest.approx(logits[best] - logits[-1])
        assert row.family == model["families"][best]


def test_nothing_known_is_unknown(spark, model):
    grams = spark.createDataFrame([(1, [])], "n int, grams array<string>")
    assert licenses.classified(grams, model, ["n"]).first().score < 0.5


def test_nulls_repeats_and_long_texts(spark, model):
    long = "word " * 400_000 + "\nReleased under the MIT License.\nAll rights reserved."
    rows = [(1, None), (2, ""), (3, long), (3, "x"), (3, "x"), (None, "All rights reserved.")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.family, r.n_licences) for r in licenses.scan(frame, model).collect()))
    families = {family for doc_id, family, n in got if doc_id == 3 and n == 2}
    assert families <= {"MIT", "Proprietary"} and len(families) == 1
    assert [x for x in got if x[2] != 2] == [
        (0, "Proprietary", 1), (1, "unknown", 0), (2, "unknown", 0), (3, "unknown", 0), (3, "unknown", 0),
    ]
    assert licenses.scan(frame.limit(0), model).collect() == []


def test_main_path_has_no_python(spark, docs, model):
    plan = licenses.scan(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query_finds_the_lines_of_the_tables(spark, testdata):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{testdata}/documents.parquet").collect()}
    fixed = {line: family for family, line in licenses.TEMPLATES}
    for row in licenses.op4_licenses(spark, testdata).collect():
        held = {fixed[line] for line in texts[row.doc_id].split("\n") if line in fixed}
        assert row.family in held if held else row.family == "unknown"


def test_common_notices_are_found(spark):
    """A notice in each third document does not turn its own words into common ones."""
    notices = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0."]
    rows = [(n, f"Some words about the house {n}\nand the garden of it\nand more", 1, "f") for n in range(600)]
    rows += [(600 + n, f"Words here {n}\n{notices[n % 8 == 0]}\nwords after it", 1, "f") for n in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: (r.family, r.n_licences) for r in licenses.scan(frame, licenses.fit(frame)).collect()}
    for n in range(300):
        assert got[600 + n] == ("Apache-2.0" if n % 8 == 0 else "MIT", 1)
    assert {got[n] for n in range(600)} == {("unknown", 0)}


WRAPPED = {
    "This work is licensed under the GNU\nGeneral Public License, version 3.": "GPL-3.0",
    "# This work is licensed under the GNU General Public License, version\n# 2.": "GPL-2.0",
    " * Permission is hereby granted, free of charge, to any person obtaining a copy\n * of this software and associated "
    "documentation files, to deal in the\n * Software without restriction": "MIT",
    "// Redistribution and use in source and binary forms, with or without\n// modification, are permitted provided that the "
    "following conditions\n// are met": "BSD",
    "This work is licensed under a Creative Commons Attribution-\nShareAlike 4.0 International License.": "CC-BY-SA-4.0",
    "Licensed\nunder\nthe\nApache\nLicense,\nVersion\n2.0.": "Apache-2.0",
}


def test_wrapped_notices_are_read_whole(spark, model):
    rows = [(n, f"Words before it\n{text}\nwords after it") for n, text in enumerate(WRAPPED)]
    rows += [(10, "This work is licensed under the GNU\n\nGeneral Public License, version 3."), (11, "All rights\nreserved\nAll rights reserved.")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.family, r.n_licences) for r in licenses.scan(frame, model).collect()}
    assert got == {n: (family, 1) for n, family in enumerate(WRAPPED.values())} | {10: ("unknown", 0), 11: ("Proprietary", 2)}
