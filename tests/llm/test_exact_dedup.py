import hashlib
import re

import llm_data

from evalspark.llm import exact_dedup


def brute(rows):
    groups = {}
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(i, min(known) if known else None, len(ids), sha) for i in ids]
    return sorted(out, key=str)


ROWS = [
    (3, "a  b"), (1, "a\tb"), (9, "a b "), (2, None), (5, ""), (7, "x\x0b\x0cy"), (8, "x y"), (8, "x y"),
    (None, "a b"), (None, "only"), (None, "only"), (11, "ünï\u00a0code"), (10, "long " * 50_000), (12, "long " * 50_000),
]


def test_groups_match_brute_force(spark):
    found = exact_dedup.exact_groups(llm_data.documents(spark, ROWS)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == brute(ROWS)
    kept = {}
    for r in found:
        kept.setdefault(r.text_sha256, []).append(r)
    for rows in kept.values():
        stays = [r for r in rows if r.kept]
        assert len(stays) == 1 and stays[0].doc_id == stays[0].keep_id


def test_drop_keeps_one_whole_row_per_text(spark):
    docs = llm_data.documents(spark, ROWS)
    out = exact_dedup.drop_exact(docs)
    assert out.columns == docs.columns
    assert len(out.collect()) == len({r[-1] for r in brute(ROWS)})


def test_hot_text_and_empty_table(spark):
    rows = [(i, "same text") for i in range(600)] + [(i, f"t{i}") for i in range(600, 700)]
    found = exact_dedup.exact_groups(llm_data.documents(spark, rows)).filter("kept").collect()
    assert len(found) == 101 and min(r.doc_id for r in found) == 0
    empty = llm_data.documents(spark, rows).limit(0)
    assert exact_dedup.exact_groups(empty).collect() == []
    assert exact_dedup.drop_exact(empty).collect() == []
