import hashlib
import re
from collections import Counter

from awkward import corpus, documents, empty, prose
from pyspark.sql import functions as F

from statquarry.llm.fill_middle import Rates, fill_in_middle, restore

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plain(id, text, seed="1", percent=90, suffix_first=20):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if id is None else id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    u = UNIT.findall(text)
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return id, len(u), "plain", None, None, text
    pre, mid, suf = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h4 % 100 < suffix_first:
        return id, len(u), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return id, len(u), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


ODD = ["a<P>b", "<M>", "<S", "<P", ">", "P>", "<<S>x", "a<", "S>" * 9, "日本語abcé́x", "a\u0000b", "\n\t ", "aZ[`{@zA", "𝒳y𝒳", "<" * 40]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check(spark, rows, rates=Rates()):
    out = restore(fill_in_middle(documents(spark, rows), rates=rates)).collect()
    expected = [plain(i, t, rates.seed, rates.percent, rates.suffix_first) for i, t in rows]
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out) == Counter(expected)
    assert Counter((r.doc_id, r.restored) for r in out) == Counter((i, t or "") for i, t in rows)
    for r in out:
        assert r.output_sha256 == sha(r.output) and r.restored_sha256 == sha(r.restored)
        raw = [r.restored.encode(), b"<P><S><M>"]
        assert b"".join(raw[p.buffer][p.start : p.start + p.length] for p in r.pieces) == r.output.encode()
    return out


def test_all_forms_against_plain_strings(spark):
    rows = corpus() + [(100 + k, t) for k, t in enumerate(ODD * 6)] + [(1000 + k, prose(k, k % 40)) for k in range(300)]
    out = check(spark, rows)
    assert {r.form for r in out} == {"plain", "psm", "spm"}


def test_rates_and_seed_are_parameters(spark):
    rows = [(k, prose(k, 30)) for k in range(40)]
    assert {r.form for r in check(spark, rows, Rates("9", 100, 0))} == {"psm"}
    assert {r.form for r in check(spark, rows, Rates("9", 100, 100))} == {"spm"}
    assert {r.form for r in check(spark, rows, Rates("9", 0, 100))} == {"plain"}


def test_empty_table_and_a_very_long_text(spark):
    assert restore(fill_in_middle(empty(spark))).collect() == []
    check(spark, [(3, prose(3, 300_000)), (4, "x" * 3_000_000), (5, "あ" * 500_000), (6, None)])


def test_restoring_keeps_other_columns(spark):
    made = fill_in_middle(documents(spark, [(1, "one two three"), (1, "one two three")])).withColumn("lang", F.lit("me"))
    assert [(r.restored, r.lang) for r in restore(made).collect()] == [("one two three", "me")] * 2
