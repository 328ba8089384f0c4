"""License scans: notices in prose, held-out wordings, the anchor filter, plan and edges."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from firmdyn.llm.license_classifier import NOTICES, anchors, notice_table, scan_licenses
from firmdyn.llm.queries import op10_license_classifier
from tests.conftest import SF001

SCHEMA = "doc_id long, text string, licenses string, probability double, family string"
PROSE = "Of the people and by the house it was on a general day.\nThe public was there, under the sky. "


def rows():
    out, want = [], {}

    def add(text, licenses):
        out.append((len(out), text, "x", 0.0, "y"))
        want[len(out) - 1] = licenses

    for family, texts in NOTICES.items():
        for t in texts:
            add(t, family)
            add(PROSE + "\n" + t.upper() + "\n" + PROSE, family)
            half = t.split()
            add(PROSE + "\n" + " ".join(half[:len(half) // 2]) + "\n" + " ".join(half[len(half) // 2:]), family)
    add("Licensed under the Apache License, version 1.1!", "Apache")  # another version and punctuation
    add("Copyright me.\nReleased under the MIT License.\n" + PROSE * 3 + "\nLicensed under CC BY-NC 4.0.\n", "CC-BY-NC,MIT")
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    gpl = "This work is licensed under the GNU General Public License, version 3."
    lgpl = "You should have received a copy of the GNU Lesser General Public License along with this library."
    isc = "Released under the ISC License."
    for a, b, want_both in ((mit, apache, "Apache,MIT"), (gpl, lgpl, "GPL,LGPL"), (gpl, mit, "GPL,MIT"), (isc, lgpl, "ISC,LGPL")):
        for join in (" ", "\n", "\n\n", "\n" + PROSE + "\n"):
            add(a + join + b, want_both)
            add(b + join + a, want_both)
    add(" ".join([mit, apache, gpl]), "Apache,GPL,MIT")
    add("Licensed under CC BY 4.0.\nLicensed under CC BY-SA 4.0.", "CC-BY,CC-BY-SA")
    # wordings that the notices do not hold as they stand
    add("Licensed under either of Apache License, Version 2.0 or MIT license at your option.", "Apache,MIT")
    add("Licensed under either of\n * Apache License, Version 2.0 (LICENSE-APACHE or http://www.apache.org/licenses/LICENSE-2.0)\n"
        " * MIT license (LICENSE-MIT or http://opensource.org/licenses/MIT)\nat your option.", "Apache,MIT")
    add("This library is dual licensed under the MIT License and the Apache License, Version 2.0.", "Apache,MIT")
    add("// SPDX-License-Identifier: Apache-2.0", "Apache")
    add("# SPDX-License-Identifier: MIT\nimport os", "MIT")
    add("SPDX-License-Identifier: Zlib", "")
    add("Licensed under the Nonsense Public License.", "")
    add("All of this is made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution.", "EPL")
    for t in (None, "", "\n\n", "the", PROSE, "He has a license to drive under the bridge.", "Released under the",
              "A general public license of the house.", "Der Hund ist mit der Katze und mit dem Haus.", "x " * 200_000):
        add(t, "")
    return out, want


@pytest.fixture(scope="module")
def scanned(spark):
    data, want = rows()
    docs = spark.createDataFrame(data, SCHEMA).repartition(4)
    return docs, want, {r.doc_id: r for r in scan_licenses(docs).collect()}


def test_notices_are_found_and_prose_is_not(scanned):
    _, want, got = scanned
    wrong = {i: (got[i].licenses, w) for i, w in want.items() if got[i].licenses != w}
    assert not wrong
    assert all((r.probability is None) == (r.licenses == "") for r in got.values())
    assert all(r.n_families == len([x for x in r.licenses.split(",") if x]) for r in got.values())


def test_anchors_lose_nothing(scanned):
    docs, _, got = scanned
    some = docs.where(F.coalesce(F.length("text"), F.lit(0)) < 2000)
    full = {r.doc_id: r.licenses for r in scan_licenses(some, use_anchors=False).collect()}
    assert full == {i: got[i].licenses for i in full} and len(full) > 60


def test_every_confirmable_paragraph_has_an_anchor(spark):
    notices = notice_table(spark).collect()
    held = set(anchors(notices, 0.6))
    for n in notices:
        missing = [p for p in n.pairs if p not in held]
        assert len(missing) < 0.6 * len(n.pairs)


def test_given_documents(spark):
    found = op10_license_classifier(spark, SF001)
    buf = io.StringIO()
    with redirect_stdout(buf):
        found.explain()
    assert not any(x in buf.getvalue() for x in ("Python", "Pandas", "Arrow", "Exchange"))  # native, no shuffle
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    lines = {"Apache": "Licensed under the Apache License", "MIT": "Released under the MIT License",
             "GPL": "licensed under the GNU General Public License", "CC-BY-NC": "Licensed under CC BY-NC"}
    want = docs.select("doc_id", *[F.col("text").contains(v).alias(k) for k, v in lines.items()])
    for r in found.join(want, "doc_id").collect():
        assert r.licenses == ",".join(k for k in sorted(lines) if r[k])


def test_empty_and_repeated(spark):
    assert scan_licenses(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame([(1, "Released under the MIT License."), (1, "Released under the MIT License."), (None, "MIT")],
                                 "doc_id long, text string")
    assert sorted((str(r.doc_id), r.licenses) for r in scan_licenses(docs).collect()) == [("1", "MIT"), ("1", "MIT"), ("None", "")]
