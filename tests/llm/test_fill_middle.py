"""Fill-in-the-middle documents against plain string work."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quotelake.llm import fill_middle
from quotelake.llm.catalog import ORACLES, QUERIES
from tests.oracle_check import compare, connect

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    head = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(head[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aZ<>PSMé\U0001f600 \n[`{@", max_size=40), st.integers(-5, 10_000))
def test_arrangement_and_its_inverse(text, doc_id):
    n, form, pieces, _ = fill_middle.arrange(text, doc_id)
    output = "".join(p.text() for p in pieces)
    want = expected(doc_id, text)
    assert (n, form, output) == (want[1], want[2], want[5])
    assert "".join(p.text() for p in fill_middle.rearrange(output, form)) == text
    assert fill_middle.digest(pieces) == sha(output)


def test_pieces_share_their_buffer():
    text = "one two three " * 1000
    _, _, pieces, parts = fill_middle.arrange(text, 1)
    assert parts and all(p.buffer is text for p in parts)
    assert sum(p.stop - p.start for p in parts) == len(text)
    assert [p.text() for p in fill_middle.Piece("abcdef", 1, 6).cut(0, 2, 2, 5)] == ["", "bc", "", "def", ""]


@pytest.mark.parametrize("parts", [1, 4])
def test_documents(spark, parts):
    rng = random.Random(5)
    letters = "ab <>PSM.\né中\U0001f600"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randrange(60)))) for i in range(300)]
    rows += [(None, "no id"), (None, None), (400, ""), (401, None), (402, "has <M> in it"), (7, "same id"), (7, "same id"), (-3, "minus")]
    rows += [(500, "word, " * 1_500_000), (501, "x" * 5_000_000), (502, "." * 4_500_000)]
    schema = "doc_id bigint, text string, n int, output string, _form string"
    df = spark.createDataFrame([(*r, 1, "o", "f") for r in rows], schema).repartition(parts)
    made = fill_middle.fill_in_middle(df)
    back = fill_middle.restore(made, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"])
    key = str
    got = sorted([tuple(r) for r in back.collect()], key=key)
    want = [expected(*r) for r in rows]
    assert got == sorted([(*w, sha(w[5]), t or "", sha(t or "")) for w, (_, t) in zip(want, rows, strict=True)], key=key)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_outputs_that_no_form_made(spark):
    rows = [("psm", None), (None, "x"), ("psm", "no marks"), ("spm", "<P>a<S>b<M>c"), ("psm", "x<P>a<S>b<M>c"), ("odd", "x"), ("plain", "<P>")]
    df = spark.createDataFrame(rows, "form string, output string")
    got = fill_middle.restore(df, ["form"])
    assert got.columns == ["form", "restored", "restored_sha256"]
    assert [r.restored for r in got.collect()] == [None] * 6 + ["<P>"]
    assert fill_middle.restore(df, []).where("restored is not null").count() == 1
    with pytest.raises(ValueError):
        fill_middle.restore(df.withColumn("restored", df.form), ["restored"])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert fill_middle.restore(fill_middle.fill_in_middle(df), ["doc_id"]).count() == 0


def test_query_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert compare(spark, connect(folder), folder, QUERIES["op12_fill_middle"], ORACLES["op12_fill_middle"]) is None
