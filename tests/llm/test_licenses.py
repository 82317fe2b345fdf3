"""Licence scans: templates and variants are found, ordinary text isn't, and the plan gives the model's own scores."""

import re
import textwrap

import pytest

from newsmart.llm import licenses

DOCS = "/root/testdata/sf0.01/documents.parquet"
NOTICE = re.compile(r"^(Released under the MIT|Licensed under|This work is licensed|All rights reserved)")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(DOCS)


@pytest.fixture(scope="module")
def model(docs):
    return licenses.fit(docs)


def test_every_notice_of_the_documents_and_nothing_else(docs, model):
    got = {r.doc_id: r for r in licenses.licenses(docs, model=model).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(got) == set(texts)
    for d, t in texts.items():
        own = [x for x in t.split("\n") if NOTICE.search(x)]
        assert (got[d].n_notices, got[d].n_confirmed) == (len(own), len(own)), own
        wanted = {"MIT": "mit", "Apache": "apache", "GNU": "gpl", "BY-NC": "cc-by-nc", "All rights": "reserved"}
        assert got[d].families == ",".join(sorted({f for x in own for k, f in wanted.items() if k in x}))


def test_templates_and_unknown_notices(spark, model):
    lines = [(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts]
    rows = [(i, t.upper() if i % 2 else t) for i, (_, t) in enumerate(lines)]
    got = {r.doc_id: r for r in licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string"), model=model).collect()}
    assert sum(got[i].families == f for i, (f, _) in enumerate(lines)) >= 0.95 * len(lines)
    odd = spark.createDataFrame([(1, "Licensed under the Foo License, Version 7."), (2, "the house of the rising sun")], "doc_id long, text string")
    one, two = sorted(licenses.licenses(odd, model=model).collect())
    assert one.n_confirmed <= one.n_notices and two.n_notices == 0


def test_plan_and_model_agree(spark, model):
    texts = ["Released under the MIT License.", "foo bar\nAll rights reserved.\n\nx", "Text under the Creative Commons license", "GNU public", "Copyright", "license " * 300]
    lines = [(i, n, x) for i, t in enumerate(texts) for n, x in enumerate(t.split("\n"))]
    df = spark.createDataFrame(list(enumerate(texts)), "uid long, text string")
    got = {(r.uid, r.line_no): r for r in licenses.notices(df, model).collect()}
    for uid, n, line in lines:
        p = model.probabilities(line)
        best = model.families[p.argmax()]
        assert ((uid, n) in got) == (best != licenses.NONE)
        if best != licenses.NONE:
            r = got[uid, n]
            assert abs(r.score - p.max()) < 1e-9
            assert r.family == (best if p.max() >= model.least[best] else licenses.UNKNOWN)


def test_lines_without_signals_cannot_be_notices(model):
    gain = {f: [max(0.0, x - v[-1]) for x in v[:-1]] for f, v in model.weights.items() if not set(f.split()) & set(model.signals)}
    for k in range(len(model.families) - 1):
        assert model.bias[k] + sum(g[k] for g in gain.values()) < model.bias[-1]


def test_odd_rows(spark, model):
    rows = [(1, None, 1), (2, "", 1), (None, "All rights reserved.", 1), (2, "x\n" * 30_000 + "Released under the MIT License.", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, uid int")
    got = sorted(((r.doc_id, r.n_notices, r.families) for r in licenses.licenses(docs, model=model).collect()), key=repr)
    assert got == [(1, 0, ""), (2, 0, ""), (2, 1, "mit"), (None, 1, "reserved")]
    assert licenses.licenses(docs.limit(0)).collect() == []


@pytest.mark.parametrize("mark", ["", "# ", " * "])
def test_wrapped_notices_are_found(spark, model, mark):
    cases = [(f, t, w) for f, ts in licenses.TEMPLATES.items() for t in ts for w in (40, 60, 80)]
    texts = ["ordinary words before it\n\n" + "\n".join(mark + x for x in textwrap.wrap(t, w, break_on_hyphens=False)) + "\n\nand after it" for _, t, w in cases]
    got = {r.doc_id: r for r in licenses.licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model=model).collect()}
    right = [got[i].families == f and got[i].n_confirmed >= 1 for i, (f, _, _) in enumerate(cases)]
    assert sum(right) >= 0.95 * len(cases), [c for c, r in zip(cases, right, strict=True) if not r]


def test_licences_that_are_no_template(spark, model):
    lines = {
        "SPDX-License-Identifier: ISC": {"isc"}, "EPL-2.0": {""}, "SPDX-License-Identifier: EPL-2.0": {"epl"}, "Released under the Unlicense.": {"unlicense"},
        "Released under the zlib license": {"zlib"}, "Released under the BSD 2-Clause license": {"bsd"},
        "This file is licensed under the GNU Affero General Public License, version 3": {"agpl"},
        "Licensed under the Foo License, Version 7.": {""}, "Released under the terms of the Quux Public License.": {""}, "SPDX-License-Identifier: Frob-2.0": {""},
    }
    got = {r.doc_id: r for r in licenses.licenses(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), model=model).collect()}
    for i, (line, families) in enumerate(lines.items()):
        assert got[i].families in families | {""}, line  # never a wrong family
        if line != "EPL-2.0":
            assert got[i].n_confirmed or got[i].n_unknown, line  # and never silent


def test_neighbouring_notices_stay_apart(spark, model):
    text = "Released under the MIT License.\nAll rights reserved.\nLicensed under the Apache License, Version 2.0.\n\nx"
    (row,) = licenses.licenses(spark.createDataFrame([(1, text)], "doc_id long, text string"), model=model).collect()
    assert (row.n_notices, row.n_confirmed, row.families) == (3, 3, "apache,mit,reserved")
