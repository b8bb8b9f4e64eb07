"""The filter audit against filters that run one after the other in plain Python."""

import random
import re
from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from paneloom.llm import audit

COLUMNS = ["part", "filter_order", "step", *audit.COUNTS]


def plain_audit(docs, labels):
    good, toxic = ({k for k, *marks in labels if k is not None and marks[m] == 1} for m in (0, 1))
    least = {}
    for k, text, _ in docs:
        if k is not None:
            least[text or ""] = min(k, least.get(text or "", k))
    rows = []
    for k, text, lang in docs:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        failed = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": k is not None and k > least[text],
        }
        rows.append((lang or "", k, {x for x, f in failed.items() if f}))
    out = {}
    for part in {r[0] for r in rows}:
        removed_by = Counter()
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            for step, own in enumerate(order):
                gone = [r for r in left if own in r[2]]
                left = [r for r in left if own not in r[2]]
                removed_by[own] += len(gone)
                mine = [r for r in rows if r[0] == part and own in r[2]]
                out[part, "".join(order), step + 1] = [
                    len(left), len(gone), len(mine) - len(gone), sum(r[2] == {own} for r in mine), sum(r[1] in good for r in gone), sum(r[1] in toxic for r in gone),
                ]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(removed_by[order[step - 1]])
    return out


def tables(spark, docs, labels):
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    clash = ("part", "code", "d1", "d2", "first", "good", "toxic", "n", "held", "quality")
    return frame.withColumns({c: F.lit("clash") for c in clash}), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("clash"))


def test_audit_equals_filters_in_turn(spark):
    rng = random.Random(5)
    words = ["alpha", "BETA", "gamma", "$", "delta#", "Epsilon", "Жук", "zeta"]
    body = lambda: " ".join(rng.choice(words) + str(rng.randint(0, rng.choice([3, 400]))) for _ in range(rng.choice([1, 40, 130])))
    pool = [body() for _ in range(60)] + [" ".join(f"own{k}" for k in range(150)), "", None, " \n\t", "A", " ".join(["w"] * 100)]
    docs = [(k, rng.choice(pool), rng.choice(["en", "de", None, ""])) for k in range(300)]
    docs += [(7, docs[7][1], "en"), (None, docs[9][1], "en"), (None, None, None), (1000, " ".join(f"w{k}" for k in range(60_000)), "xx")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 300, 2)] + [(None, 1, 1), (4, 1, 0), (9999, 1, 1)]
    best = {}
    for k, *marks in labels:
        best[k] = [max([m for m in (a, b) if m is not None], default=0) for a, b in zip(best.get(k, [0, 0]), marks)]
    out = audit.audit_filters(*tables(spark, docs, labels)).select(COLUMNS).collect()
    found = {tuple(r[:3]): list(r[3:]) for r in out}
    assert len(found) == len(out) == 4 * 600
    assert found == plain_audit(docs, [(k, *m) for k, m in best.items()])


def test_other_rules_and_empty_tables(spark):
    docs, labels = tables(spark, [(1, "a b", "x"), (2, "a b", "x"), (3, "c", "y")], [(2, 1, 0)])
    rules = lambda text: {"S": F.char_length(text) < 2}
    out = {tuple(r[:3]): tuple(r[3:]) for r in audit.audit_filters(docs, labels, rules, "T").select(COLUMNS).collect()}
    assert out["x", "ST", 2] == (1, 1, 0, 1, 1, 0, 2) and out["y", "TS", 2] == (0, 1, 0, 1, 0, 0, 2) and len(out) == 8
    assert audit.audit_filters(*tables(spark, [], [])).count() == 0
    assert audit.audit_filters(*tables(spark, [(1, None, None)], [])).select("kept").distinct().count() == 2
