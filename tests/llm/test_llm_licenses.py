"""Licence scan: texts of several paragraphs, in any layout, whole with titles, and known texts as a table."""

import textwrap

import pytest

from paneloom.llm import licenses
from paneloom.llm.licenses import KNOWN

MIT, NOTICE = KNOWN["MIT"], "Copyright (c) 2020 Ann Other"
WRAPPED = "\n\n".join(textwrap.fill(p, 40) for p in KNOWN["BSD-2-Clause"].split("\n"))
ROWS = {
    1: (f"{NOTICE}\n\n{MIT}\n\nimport os\nprint(os.name)\n", None, ["MIT"]),
    2: (f"MIT License\n\n{NOTICE}\n\n{MIT}\n", "MIT", ["MIT"]),
    3: ("\n".join(f"# {line}".rstrip() for line in f"{NOTICE}\nAll rights reserved.\n\n{MIT}".split("\n")), "MIT", ["MIT"]),
    4: (f"/*\n{WRAPPED}\n*/\nint main;", None, ["BSD-2-Clause"]),
    5: (f"The ISC License\n\n{KNOWN['ISC']}", "ISC", ["ISC"]),
    6: (f"{MIT.rsplit(chr(10), 1)[0]}\nno more than that", None, []),
    7: (f"We say: {MIT}", None, []),
    8: (f"{MIT}\n\n{KNOWN['ISC']}", None, ["ISC", "MIT"]),
    9: ((licenses.TEXTS / "Apache-2.0.txt").read_text(), "Apache-2.0", ["Apache-2.0"]),
    10: ("code\n" + (licenses.TEXTS / "GPL-2.0.txt").read_text().replace("51 Franklin Street", "59 Temple Place") + "\ncode", None, ["GPL-2.0"]),
    11: ("Released under the MIT License.", "MIT-notice", ["MIT-notice"]),
    12: (KNOWN["BSD-3-Clause"].replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* "), "BSD-3-Clause", ["BSD-3-Clause"]),
}


def scan(spark, texts, known=None):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r["doc_id"]: (r["whole"], r["parts"]) for r in licenses.scan_licenses(docs, known).collect()}


def test_texts_of_several_paragraphs(spark):
    found = scan(spark, {k: text for k, (text, _, _) in ROWS.items()})
    assert found == {k: (whole, parts) for k, (_, whole, parts) in ROWS.items()}


@pytest.mark.parametrize("as_table", [True, False])
def test_known_texts_as_given(spark, as_table):
    own = {"own": "Do as you\n\nlike", "short": "Free"}
    known = spark.createDataFrame([*own.items(), ("own", "Do what you like")], "license string, text string") if as_table else own
    texts = {1: "x\nDo as\nyou like\ny", 2: "do what you like", 3: "free", 4: "free beer", 5: None, 6: MIT}
    other = ("own", ["own"]) if as_table else (None, [])
    empty = (None, [])
    assert scan(spark, texts, known) == {1: (None, ["own"]), 2: other, 3: ("short", ["short"]), 4: empty, 5: empty, 6: empty}
