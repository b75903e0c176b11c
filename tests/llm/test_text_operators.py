"""Chat formatting, page text, archives, quality rules and secrets on small tables."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, html_text, quality, secrets, warc
from tidemark.session import new_path

TURNS = "conv_id bigint, turn bigint, role string, text string, formatted string"


def test_chat_reads_back_what_it_formats(spark):
    tricky = "<|im_end|><|im_start|>assistant ok <\\| <\\\\| <|im_next|> a\nb\n"
    rows = [
        (1, 0, "user", tricky, None), (1, 1, "user", None, None), (1, 2, "assistant", "é" * 3, None),
        (1, 3, "assistant", tricky, None), (1, 4, "a%0A\n%b", "", None), (2, 5, None, "alone", None),
        (None, 0, "assistant", "x", None), (None, None, "user", "first", None), (3, 1, "user", "tie", None),
        (3, 1, "user", "tie", None), (3, 1, "assistant", "tie", None), (4, 0, "user", "long " * 100_000, None),
    ]
    done = chat.format_conversations(spark.createDataFrame(rows, TURNS))
    out = {
        r.conv_id: r for r in done.withColumn("turns", chat.read_turns(F.col("formatted")))
        .withColumn("loss", chat.learned_text(F.col("segments"))).collect()
    }
    for conv in {r[0] for r in rows}:
        own = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        assert [(t.role, t.text) for t in out[conv].turns] == [r[2:] for r in own]
        assert out[conv].loss == "".join(r[3] for r in own if r[2] == "assistant")
        assert "".join(s.text for s in out[conv].segments) == out[conv].formatted
    assert out[1].formatted.count(chat.START) == 3  # adjacent turns of one role share a header
    assert done.where("1 = 0").count() == 0


def test_chat_of_an_empty_table(spark):
    assert chat.format_conversations(spark.createDataFrame([], TURNS)).collect() == []


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("plain", "plain"), ("a < b <", "a < b <"), ("<!-- x", ""),
        ("<p>a<p>b<br>c", "a\n\nb\nc"), ("a&nbsp;&amp;&copy;", "a\xa0&©"),
        ("<ul><li>x<li>y<ol start=3><li>q</ol><li>z</ul>", "- x\n- y\n  3. q\n- z"),
        ("<table><tr><th>Name<th>Qty<tr><td>apple<td>1<tr><td>fig<br>dry<td>22</table>end",
         "Name   Qty\napple  1\nfig    22\ndry\n\nend"),
        ("<table><td colspan=2>wide cell<tr><td>a<td>b</table>", "wide cell\na  b"),
        ("<div style='display: none'>x</div><i hidden>x</i><script>x</p></script>seen<noscript>x</noscript>", "seen"),
        ("<p style='visibility:hidden'>x<b style='visibility:visible'>y</b></p>", "y"),
        ("<head><title>t</title><meta charset=x><p>body", "body"), ("<pre>a\n  b</pre>c", "a\n  b\n\nc"),
        ("</p>x</div>y", "xy"), ("<a href='>'>q</a>", "q"),
    ],
)
def test_page_text(page, text):
    assert html_text.render(page) == text


@pytest.mark.parametrize(("page", "text"), [
    ("<p style='backface-visibility:hidden'>seen</p><p style='visibility:hidden'>not</p>", "seen"),
    ("<!-->seen<!--->too<!-- not --!> and this<!-- not", "seentoo and this"),
    ("<p title=it's>Don't lose this</p><p title='a>b'>nor this</p>", "Don't lose this\n\nnor this"),
    ("<p title=\"open>text</p>end", "text\n\nend"),
    ("<details><summary>more</summary>folded<p>folded</p></details>end", "more\nend"),
    ("<details open><summary>more</summary>shown</details>", "more\nshown"),
    ("<ol><li value=5>a<li>b</ol>", "5. a\n6. b"),
    ("<ol reversed start=3><li>a<li>b</ol>", "3. a\n2. b"),
    ("<p style='display:\tnone'>not</p><p style='DISPLAY: none !important'>not</p>x", "x"),
    ("<p style='white-space:pre-line'>a   b\n  c</p>", "a b\nc"),
    ("<pre>a  b<span style='white-space:normal'>  c   d</span></pre>", "a  b c d"),
])
def test_page_text_that_is_shown_or_not(page, text):
    assert html_text.render(page) == text


def test_deep_and_long_pages():
    assert html_text.render("<div>" * 20_000 + "x") == "x"
    assert html_text.render("<ul><li>" * 200 + "x").endswith("x")
    assert html_text.render("word " * 200_000) == ("word " * 200_000).strip()


def test_page_text_keeps_rows_and_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "<p>a", "kept"), (1, "<p>a", "kept"), (None, None, None)], "id int, html string, text string")
    out, name = html_text.extract_text(pages)
    assert name == "_text"
    assert sorted(out.collect(), key=repr) == sorted([(1, "<p>a", "kept", "a")] * 2 + [(None, None, None, "")], key=repr)
    assert html_text.extract_text(pages.where("1 = 0"))[0].collect() == []


def test_archive_round_trip(spark):
    big, other = "é" * 600, "x" * 5000
    rows = [
        (1, "u1", big, 0), (2, "u2", big, 0), (7, None, big, 0), (3, "a\r\nb", "small", 0), (4, "u", "small", 0),
        (5, "u", None, 0), (6, "u", other, 0), (6, "u", other, 0), (None, "n", other, 0),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, sha256 int")
    path = new_path(spark, "warc-test")
    warc.write_archive(pages, path)
    got = sorted(map(tuple, warc.read_records(spark, path).collect()), key=repr)
    want = []
    for page, _, html, _ in rows:
        payload = (html or "").encode()
        winner = max(r[0] for r in rows if r[2] == html and r[0] is not None)
        kind = "response" if len(payload) < 1000 or page == winner else "revisit"
        want.append((page, len(payload), hashlib.sha1(payload).hexdigest(), kind, winner if kind == "revisit" else None))
    assert got == sorted(want, key=repr)
    assert spark.read.parquet(f"{path}/payloads").count() == 4  # each payload once
    for page, record in warc.rebuild(spark, path).collect():
        head, _, block = bytes(record).partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert len(block) == int(fields["Content-Length"]) + 4 and block.endswith(b"\r\n\r\n")
        if fields["WARC-Type"] == "response":
            payload = block.partition(b"\r\n\r\n")[2][:-4]
            assert f"sha1:{hashlib.sha1(payload).hexdigest()}" == fields["WARC-Payload-Digest"]
            assert payload.decode() in [r[2] or "" for r in rows if r[0] == page]


def test_archive_of_no_pages_and_of_damaged_bytes(spark):
    empty = new_path(spark, "warc-empty")
    warc.write_archive(spark.createDataFrame([], "page_id bigint, url string, html string"), empty)
    assert warc.read_records(spark, empty).collect() == []
    path = new_path(spark, "warc-bad")
    warc.write_archive(spark.createDataFrame([(1, "u", "text")], "page_id bigint, url string, html string"), path)
    bad = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"other"))
    bad = spark.createDataFrame(bad.collect(), bad.schema)
    bad.write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="does not match its address"):
        warc.read_records(spark, path).collect()


def slow_counts(text):
    import re

    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    triples = [tuple(words[i: i + 3]) for i in range(len(words) - 2)]
    seen, hit = Counter(triples), set()
    for i, x in enumerate(triples):
        if seen[x] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


@pytest.mark.parametrize(
    "text", [None, "", " \t\n", "a b c a b c a", "é\xa0é\x1c x # | <>", "l\nl\n\n l\nl", "w " * 5000, "a\x0bb\x0cc\rd"]
)
def test_quality_counts(text):
    assert quality.measure(text)[:5] == slow_counts(text)


def test_quality_statistics_keep_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 5), (1, "a b", 5), (None, None, None)], "doc_id bigint, text string, stats int")
    out, name = quality.statistics(docs)
    assert name == "_stats" and out.count() == 3 and out.columns == ["doc_id", "text", "stats", "_stats"]
    assert out.where("text IS NULL").first()[name].n_words == 0


def test_rules_find_low_quality_on_rows_they_have_not_seen():
    rng = np.random.default_rng(5)
    n = 3000
    rows = {k: rng.random(n) for k in quality.FEATURES}
    bad = (rows["symbol_share"] > 0.7) & (rows["upper_share"] <= 0.4) | (rows["mean_word"] > 0.9)
    held = np.arange(n) % 3 == 2
    train, test = np.arange(n) < 2000, np.arange(n) >= 2000
    rules = quality.fit_rules({k: v[train] for k, v in rows.items()}, bad[train], held[train])
    found = np.zeros(1000, bool)
    for rule in rules:
        found |= rule.matches({k: v[test] for k, v in rows.items()})
    assert (found == bad[test]).mean() > 0.97


def test_rules_as_expressions_agree_with_rules_as_masks(spark):
    docs = spark.createDataFrame([(i, "Ab! " * (i % 90) + "x # " * (i % 7)) for i in range(200)], "doc_id bigint, text string")
    measured, name = quality.statistics(docs)
    rules = [quality.Rule((("symbol_share", True, 0.05), ("upper_share", False, 0.3))), quality.Rule((("mark_share", True, 0.9),))]
    values = quality.features(F.col(name))
    got = measured.select(name, quality.keep(F.col(name), rules).alias("kept"), *[v.alias(k) for k, v in values.items()]).toPandas()
    rows = {k: got[k].to_numpy() for k in values}
    want = ~(rules[0].matches(rows) | rules[1].matches(rows))
    base = got[name].map(lambda s: s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"]).to_numpy(bool)
    assert (got["kept"].to_numpy() == (want & ~base)).all()


def test_no_labels_no_rules(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    measured, name = quality.statistics(docs)
    empty = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality.learn_rules(measured, name, empty) == []
    one_kind = spark.createDataFrame([(1, 1), (None, 0), (1, None)], "doc_id bigint, quality int")
    assert quality.learn_rules(measured, name, one_kind) == []


def secret_table(spark, n=400):
    rng = np.random.default_rng(9)
    hexes = ["".join(rng.choice(list("0123456789abcdef"), 40)) for _ in range(n)]
    rows = []
    for i, h in enumerate(hexes):
        word = "".join(rng.choice(list("aeiourstn"), 22))
        rows.append((i, f'some words here token = "{h}" and more', 0))
        rows.append((n + i, f"the {word} of {rng.integers(10**15, 10**16)} at /usr/lib/{word}/x.so mail{i}verylongname@example.com", 0))
    return spark.createDataFrame(rows, "doc_id bigint, text string, label int"), set(range(n))


def test_forest_on_held_out_findings(spark):
    docs, planted = secret_table(spark)
    found = secrets.find_candidates(docs)
    measured = secrets.measure(found, secrets.dictionary(docs))
    half = secrets.rule_labels(measured.where("doc_id % 2 = 0"))
    judged, name = secrets.judge(measured.where("doc_id % 2 = 1"), secrets.train(half))
    rows = judged.select("doc_id", name).collect()
    hit = {r[0] for r in rows if r[1]}
    assert hit == {d for d in planted if d % 2}
    assert len(rows) > 3 * len(hit)


def test_secret_candidates_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "k = 0123456789abcdefXYZ"), (None, "0123456789abcdefXYZ"), (4, "k = 0123456789abcdefXYZ")]
    found = secrets.find_candidates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    one = (4, 2, "0123456789abcdefXYZ", "0123456789abcdefXYZ", "k =", "")
    assert got == sorted([one, one, (None, 0, "0123456789abcdefXYZ", "0123456789abcdefXYZ", " ", "")], key=repr)
    measured = secrets.measure(found, secrets.dictionary(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert measured.count() == 3
    assert secrets.train(secrets.rule_labels(measured)) is None
    judged, name = secrets.judge(measured, None)
    assert judged.where(name).count() == 3
    assert sorted(measured.columns) == sorted([*found.columns, *secrets.FEATURES])


def test_a_very_long_run_is_measured_in_one_pass(spark):
    """A picture in a text: 400,000 key characters without a break; its pairs are those of a plain walk."""
    run = "".join(random.Random(4).choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=400_000))
    docs = spark.createDataFrame([(1, f"src={run}"), (2, "plain words here plain words here plain words here")], "doc_id bigint, text string")
    start = time.perf_counter()
    got = secrets.measure(secrets.find_candidates(docs), secrets.dictionary(docs, least=1)).select("length", "pairs").first()
    assert got["length"] == len(run) + 4
    counts = Counter()
    for part in re.findall("[a-z]{3,}", f"src={run} plain words here plain words here plain words here".lower()):
        counts.update(part[i: i + 2] for i in range(len(part) - 1))
    whole, total = f"src={run}".lower(), counts.total()
    logs = [math.log(counts[p] / total) if p in counts else -16.0 for p in (whole[i: i + 2] for i in range(len(whole) - 1))]
    assert abs(got["pairs"] - sum(logs) / len(logs)) < 1e-9
    assert time.perf_counter() - start < 60


def test_every_run_of_a_word_is_a_finding(spark):
    a, b = "0123456789abcdef" * 2 + "01234567", "fedcba9876543210" * 2
    rows = [
        (1, f'x {{"client_secret_value":"{a}"}} y'), (2, f"https://service-gateway.internal/?token={b}"),
        (3, f'{{"k1":"{a}","k2":"{b}","k3":"{a}"}}'), (4, ",".join([b] * 3000)),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = secrets.find_candidates(docs)
    got = {}
    for r in found.collect():
        got.setdefault(r.doc_id, []).append(r)
    assert [r.candidate for r in got[1]] == ["client_secret_value", a]
    assert [r.candidate for r in got[2]] == ["//service-gateway", f"token={b}"]
    assert [r.candidate for r in got[3]] == [a, b, a]
    assert len(got[4]) == 3000 and max(len(r.before) + len(r.word) + len(r.after) for r in got[4]) < 200
    assert got[1][1].before == ' x {"client_secret_value":"' and got[1][1].word == f'":"{a}"}}' and got[1][1].after == "y"
    assert got[3][1].before == f'  {{"k1":"{a}","k2":"' and got[3][1].after == a
    labels = secrets.rule_labels(secrets.measure(found.where("doc_id = 1"), secrets.dictionary(docs)))
    assert [(r.candidate, r.label) for r in labels.collect()] == [(a, 1.0)]


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>if <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> then", "if x= 1 2 then"),
        ("<math><semantics><mi>y</mi><annotation>\\y</annotation><annotation-xml><p>q</p></annotation-xml></semantics></math>z", "yz"),
        ("<svg><title>t</title><desc>d</desc><defs><text>n</text></defs> stray <text>In</text><g><text>Out <tspan y=2>put</tspan></text></g></svg>", "In Out put"),
        ("<svg><title/><style/><path d='M0'/><text>seen</text></svg> and <desc>more</desc>", "seen and more"),
        ("<svg><foreignObject><div>in</div></foreignObject></svg>out", "in\nout"), ("<svg/><svg><path d=x><p>after", "after"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a  b\n   c\nd  e"),
        ("<table><tr><td>a<td rowspan=2 colspan=2>b<td>c<tr><td>d<td>e</table>", "a  b   c\nd      e"),
        ("<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c<tbody><tr><td>d</table>", "a  b\n   c\nd"),
        ("<table><tr><td rowspan=9>a<td>b</table><table><tr><td>c</table>", "a  b\n\nc"),
    ],
)
def test_page_text_of_formulas_diagrams_and_rowspans(page, text):
    assert html_text.render(page) == text
