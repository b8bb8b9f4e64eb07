"""License scans (10): canonical digests of whole texts and runs of lines, hash-joined to the digests of known licences."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from itertools import product
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paneloom.llm.tasks import LOWER, documents
from paneloom.session import cut_lineage

# Texts of short public licences and of the notices that stand for longer ones.
AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
AUTHOR_DISCLAIMS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
    "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
HOLDERS_DISCLAIM = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
REDISTRIBUTION = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.\n"
)
GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
KNOWN = {
    "0BSD": f"{GRANT}.\n\n{AUTHOR_DISCLAIMS}",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": f"{REDISTRIBUTION}\n{HOLDERS_DISCLAIM}",
    "BSD-3-Clause": f"{REDISTRIBUTION}3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    f"products derived from this software without specific prior written permission.\n\n{HOLDERS_DISCLAIM}",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": f"{GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{AUTHOR_DISCLAIMS}",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
    "the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions "
    f"of the Software.\n\n{AS_IS}",
    "MIT-notice": "Released under the MIT License.",
}

#: Full texts, each in a file that is named by its licence.
TEXTS = Path(__file__).with_name("texts")
TERMS_END = "END OF TERMS AND CONDITIONS"

# Spellings that count as equal, as words of the canonical form.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "authorisation": "authorization", "authorised": "authorized", "favour": "favor", "fulfil": "fulfill",
    "https": "http", "initialise": "initialize", "judgement": "judgment", "labour": "labor", "licence": "license", "licenced": "licensed",
    "licences": "licenses", "non commercial": "noncommercial", "non infringement": "noninfringement", "organisation": "organization",
    "per cent": "percent", "sub license": "sublicense", "utilisation": "utilization", "whilst": "while",
}
COPYRIGHT = "(?m)^[ \\t]*(copyright|\\(c\\)|©|all rights reserved)[^\\n]*$"  # for the SQL; tasks judge by copyright_line
#: Nearly every licence holds one of these; where all known texts do, a text without them cannot match.
ANCHORS = ("licen", "permission", "redistribution")
HEAD = 4  # words at the start of a line that decide whether a known text may begin there

LINE_END = re.compile(r"\r\n?|\n")
WORD = re.compile("[a-z0-9]+")
MARKED = re.compile(r"(?:[^0-9a-z(©]|\((?!c\)))*(©|\(c\)|copyright|all rights reserved)")  # behind comment signs
DATED = re.compile(r"[^0-9a-z(©]*(?:©|\(c\)|(?:19|20)\d\d)")
#: What follows "copyright" or "(c)" at the start of a line of running text.
PROSE = frozenset(
    "a accompany act acts also an and any applicable are assertion be but claim claims disclaimer disclaimers doctrine each ed exists for from give "
    "has have holder holders if in include infringement information interest interests is it its law laws legend license licence licensed licenses line "
    "licences make material materials may must no not notice notices of offer on or our owner owners ownership page patent permission permissions "
    "protection provide resulting right rights s sharing statement statements status such terms than that the these this those to trademark "
    "treaties treaty under use was we when where which with work works you your".split()
)
_NAMES = (
    "0bsd|apache|artistic|boost software|(?:new |modified |revised |simplified |free|original |zero clause |[234] clause )?bsd(?: [0234] clause)?"
    "(?: simplified| new or revised| new| revised| original or old| zero clause| zero)?|expat|gnu (?:affero |lesser |library )?general public|"
    "gnu free documentation|isc|mit|mozilla public|x11|zlib|zlib libpng"
)
#: Leading lines that name a licence, as words. They belong to no text, known ones included.
TITLE = re.compile(
    rf"(?:the )?(?:{_NAMES}) licen[sc]e(?: (?:{_NAMES}))?|licen[sc]e(?: {_NAMES})?|(?:the )?unlicense|spdx license identifier .*|"
    "(?:mozilla public license )?version [0-9] [0-9]|version [0-9](?: [0-9])?(?: [0-9]{1,2})? [a-z]+ [0-9]{4}|http www apache org licenses|"
    "creative commons legal code|cc0 1 0 universal"
)
_PAIRS = {tuple(old.split()): new for old, new in SPELLINGS.items() if " " in old}


def common_licenses() -> list[tuple[str, str]]:
    """(license, text): the known texts above, usual wordings of theirs, and the full texts in ``TEXTS``, whole,
    without the appendix behind their terms, and from the preamble on, as addresses above it differ."""
    bullets, owner = (lambda t: re.sub(r"(?m)^\d\. ", "* ", t)), (lambda t: t.replace("COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR"))
    same = lambda t: t
    rows = [(name, text) for name, text in KNOWN.items()]
    rows += [(name, a(b(KNOWN[name]))) for name in ("BSD-2-Clause", "BSD-3-Clause") for a, b in product((same, bullets), (same, owner))]
    rows += [(name, KNOWN[name].replace("and/or distribute", "and distribute")) for name in ("0BSD", "ISC")]
    for file in sorted(TEXTS.glob("*.txt")):
        text = file.read_text("utf-8")
        forms, end = [text, bullets(text)] if file.stem.startswith("BSD") else [text], text.find(TERMS_END)
        if end >= 0:
            terms = text[: end + len(TERMS_END)]
            forms += [terms, text[:end], *(terms[m.start() :] for m in re.finditer(r"(?m)^[ \t]*Preamble[ \t]*$", terms))]
        rows += [(file.stem, form) for form in forms]
    return list(dict.fromkeys(rows))


def copyright_line(line: str, low: str) -> bool:
    """Whether a line states a copyright; a wrapped line of a licence may begin with the same word."""
    sign = MARKED.match(low)
    if not sign:
        return False
    if sign[1] in ("©", "all rights reserved") or DATED.match(low, sign.end()):
        return True
    after = WORD.search(low, sign.end())
    if not after:
        return sign[1] == "(c)" or low.rstrip().endswith(":")
    if sign[1] == "(c)" and re.search(r"\b(?:19|20)\d\d\b", low):
        return True
    if line[after.start() : after.start() + 3] == "The":  # of a name
        return True
    return after[0] not in PROSE


def canonical(text: str) -> tuple[list[str], list[int], int]:
    """Words of the canonical form, the places where lines begin, and how many words titles take at the front.

    Lower case, no copyright lines, ASCII letters and digits, equal spellings also across a line end.
    """
    found, begins, titles, heading = [], [], 0, True
    for line in LINE_END.split(text):
        low = line.encode("utf-8", "surrogatepass").translate(LOWER).decode("utf-8", "surrogatepass")
        if copyright_line(line, low):
            continue
        own = WORD.findall(low)
        if not own:
            continue
        begins.append(len(found))
        found += [SPELLINGS.get(w, w) for w in own]
        heading = heading and bool(TITLE.fullmatch(" ".join(found[begins[-1] :])))
        titles = len(found) if heading else titles
    words, moved = [], {}
    at = 0
    while at < len(found):
        moved[at] = len(words)
        new = _PAIRS.get((found[at], found[at + 1])) if at + 1 < len(found) else None
        words.append(new or found[at])
        at += 2 if new else 1
    return words, [moved[b] for b in begins if b in moved], moved.get(titles, len(words))


def digest(words: list[str]) -> str:
    return hashlib.sha256(" ".join(words).encode()).hexdigest()


def anchored(text: Column) -> Column:
    low = F.lower(text)
    found = F.lit(False)
    for anchor in ANCHORS:
        found = found | F.contains(low, F.lit(anchor))
    return found


def known_digests(known: DataFrame) -> DataFrame:
    """(license, digest, head, n, anchor) of a table (license, text): the digest of the canonical form, the words
    it begins with, how many it has, and whether it holds an anchor. Texts without a word are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, text in zip(batch.column("license").to_pylist(), batch.column("text").to_pylist()):
                words, _, titles = canonical(text or "")
                words = words[titles:] or words  # a notice may look like a title
                if words:
                    rows.append((name, digest(words), " ".join(words[:HEAD]), len(words), any(a in w for a in ANCHORS for w in words)))
            cols = list(zip(*rows)) if rows else [()] * 5
            kinds = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["license", "digest", "head", "n", "anchor"])

    return known.select("license", "text").mapInArrow(run, "license string, digest string, head string, n int, anchor boolean")


def units(docs: DataFrame, heads: Mapping[str, tuple[int, ...]]) -> DataFrame:
    """(doc_id, entire, digest) of each run of lines that begins and is as long as a known text."""

    sizes = sorted({head.count(" ") + 1 for head in heads})

    def of(text: str) -> Iterator[tuple[bool, str]]:
        words, begins, titles = canonical(text)
        ends = {*begins, len(words)}
        for begin in begins:
            lengths = {n for size in sizes for n in heads.get(" ".join(words[begin : begin + size]), ())}
            for n in lengths:
                if begin + n in ends:
                    found = digest(words[begin : begin + n])
                    yield False, found
                    if begin + n == len(words) and begin in (0, titles):
                        yield True, found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, entire, digests = [], [], []
            for place, text in enumerate(batch.column("text").to_pylist()):
                for whole, found in set(of(text)):
                    places.append(place)
                    entire.append(whole)
                    digests.append(found)
            ids = batch.column("doc_id").take(pa.array(places, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(entire, pa.bool_()), pa.array(digests, pa.string())], names=["doc_id", "entire", "digest"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, entire boolean, digest string")


def scan_licenses(docs: DataFrame, known: DataFrame | Mapping[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each doc_id with the licence that its whole text is (``whole``, or null), and those that runs of its
    lines are (``parts``, sorted), the run of all lines included.

    ``known`` is a table (license, text) in which a licence may have several wordings; ``common_licenses``
    when not given. A unit matches only as a whole, from the start of a line to the end of one, never by a phrase
    inside a line; how its lines and paragraphs are broken or marked as comments by signs does not matter. Leading
    titles belong to no text. Candidates are the line starts at which a known text may begin; tasks hold the first
    words and length of each known text, and the digests of candidates are joined to the known ones. What is
    joined back to the documents are keys and names, no texts. Null and empty texts match nothing; rows that share
    a doc_id share their matches, a null doc_id included; an empty table gives no rows; further columns are ignored.
    """
    docs, spark = documents(docs, id_col, text_col), docs.sparkSession
    if not isinstance(known, DataFrame):
        known = spark.createDataFrame(common_licenses() if known is None else list(known.items()), "license string, text string")
    table = cut_lineage(known_digests(known), "licenses")
    heads, all_anchored = {}, True
    for row in table.groupBy("head").agg(F.collect_set("n").alias("lengths"), F.min("anchor").alias("anchor")).collect():
        heads[row["head"]] = tuple(row["lengths"])
        all_anchored = all_anchored and row["anchor"]
    bearing = docs.where(anchored(F.col("text")) if all_anchored else F.col("text").isNotNull())
    found = units(bearing, heads).join(table.select("license", "digest"), "digest")
    named = found.groupBy(F.col("doc_id").alias("__id")).agg(
        F.min(F.when(F.col("entire"), F.col("license"))).alias("whole"), F.sort_array(F.collect_set(F.when(~F.col("entire"), F.col("license")))).alias("parts")
    )
    joined = docs.select("doc_id").join(named, F.col("doc_id").eqNullSafe(F.col("__id")), "left")
    return joined.select("doc_id", "whole", F.coalesce("parts", F.array().cast("array<string>")).alias("parts"))
