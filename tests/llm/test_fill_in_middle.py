import hashlib
import re

import llm_data
import pytest

from evalspark.llm import fill_in_middle as fim


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    hex_ = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(hex_[k : k + 8], 16) for k in (0, 8, 16, 24))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm_rate:
        return doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


ODD = [
    None, "", "\n", "\n\n\n", "one line", "ends\n", "a\n\nb", "\r\nx\r\n", "é\n😀 y\n", "has <M> inside\n",
    "<S>", "<<\n<P\n>S>\n", "<\nP>\n", "long line " * 40_000, "many\n" * 60_000,
]
ROWS = [(i, t) for i in range(12) for t in ODD]
ROWS = [(n, t) for n, (_, t) in enumerate(ROWS)] + [(3, "twice\nover\n"), (3, "twice\nover\n"), (None, "no\nid\n")]


@pytest.mark.parametrize("rates", [(100, 50), (60, 10)])
def test_output_and_form_match_brute_force(spark, rates):
    out = fim.fill_in_middle(llm_data.documents(spark, ROWS), rate=rates[0], spm_rate=rates[1]).collect()
    found = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out]
    wanted = [brute(i, t, rate=rates[0], spm_rate=rates[1]) for i, t in ROWS]
    assert sorted(found, key=str) == sorted(wanted, key=str)
    assert all(r.output_sha256 == sha(r.output) for r in out)


def test_pieces_describe_the_output_over_the_text(spark):
    texts = dict(ROWS[:-3])
    for r in fim.fill_in_middle(llm_data.documents(spark, ROWS[:-3])).collect():
        buffers = (texts[r.doc_id] or "").encode(), b"<P><M><S>"
        assert b"".join(buffers[p.mark][p.start : p.stop] for p in r.pieces).decode() == r.output
        runs = sorted((p.start, p.stop) for p in r.pieces if not p.mark)
        assert runs[0][0] == 0 and runs[-1][1] == len(buffers[0])
        assert all(x[1] == y[0] for x, y in zip(runs, runs[1:]))


def test_restore_needs_output_and_form_only(spark):
    out = fim.fill_in_middle(llm_data.documents(spark, ROWS))
    back = fim.restore(out.select("form", "output", "doc_id")).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(((i, t or "") for i, t in ROWS), key=str)
    assert all(r.restored_sha256 == sha(r.text) for r in back)


def test_empty_table_clashing_columns_and_bad_output(spark):
    docs = llm_data.documents(spark, ROWS)
    empty = fim.fill_in_middle(docs.limit(0))
    assert empty.collect() == [] and fim.restore(empty).collect() == []
    clash = docs.selectExpr("doc_id", "text", "1 AS n", "'x' AS form", "'y' AS output", "'z' AS `pieces.a`")
    assert fim.fill_in_middle(clash).count() == len(ROWS)
    bare = spark.createDataFrame([(None, None, 1), ("text", None, 2)], "output string, form string, `a.b` int")
    assert sorted(r.text for r in fim.restore(bare).collect()) == ["", "text"]
    wrong = spark.createDataFrame([("no sentinel", "psm")], "output string, form string")
    with pytest.raises(Exception, match="subsection not found"):
        fim.restore(wrong).collect()
