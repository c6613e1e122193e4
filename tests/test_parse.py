from __future__ import annotations

import random

import plain
import pytest
from pyspark.sql import functions as F

from postroom.functions import extract_patches, extract_trailers
from postroom.operators import dead_letter_text, dead_letters, parse_mail, split_raw

MAIL = b"""From: A <a@x>\r
To: b@x, "C, D" <c@x>\r
Subject: hello\r
\tfolded  \r
 more\r
Date: Fri, 15 Jun 2012 16:52:52 +0200 (CEST)\r
X-Mailing-List:\r
 y\r
References: <1@x>  <2@x>\r
Message-ID: <1@x>\r
message-id: <2@x>\r
\r
body\r
Reviewed-by: N N <n@x>\r
"""


def test_one_mail(raw):
    row = parse_mail(raw(("l", 7, MAIL))).first().asDict()
    assert row["from"] == "A <a@x>"
    assert row["to"] == ["b@x", ' "C', ' D" <c@x>']
    assert row["cc"] == [""]
    assert row["subject"] == "hello folded more"
    assert str(row["date"]) == "2012-06-15 16:52:52"
    assert row["x-mailing-list"] == " y"
    assert row["references"] == ["<1@x>", "", "<2@x>"]
    assert row["message-id"] == "<1@x>"
    assert row["in-reply-to"] == ""
    assert [tuple(t) for t in row["trailers"]] == [("Reviewed-by", "N N <n@x>")]
    assert row["code"] == []
    assert row["raw_body"] == "body\nReviewed-by: N N <n@x>"
    assert (row["list"], row["article_no"]) == ("l", 7)


def test_repeated_lists_stay_whole(raw):
    mail = b"To: a@x, b@x\nTo: c@x\nReferences: <1> <2>\n\n"
    row = parse_mail(raw(("l", 1, mail))).first()
    assert row["to"] == ["a@x, b@x", "c@x"]
    assert row["references"] == ["<1>", "<2>"]


def test_dead_letters(raw):
    mails = raw(
        ("l", 1, b" continued\n\nx"),
        ("l", 2, b"no colon here\n\nx"),
        ("l", 3, b"A: \xff\n\nx"),
        ("l", 4, b""),
        ("l", 5, b"\n\nfoo\n\n"),
        ("l", 6, b"A: b"),
    )
    dead = {r["article_no"]: r for r in dead_letters(mails).collect()}
    assert sorted(dead) == [1, 2, 3]
    assert "continuation" in dead[1]["error"] and "UTF-8" in dead[3]["error"]
    assert bytes(dead[3]["raw"]) == b"A: \xff\n\nx"
    alive = {r["article_no"]: r["raw_body"] for r in parse_mail(mails).collect()}
    assert alive == {4: "", 5: "\nfoo\n", 6: ""}
    texts = [r["text"] for r in dead_letter_text(dead_letters(mails)).collect()]
    assert all("\n" + "=" * 30 + " Exception:\n" in t for t in texts)


def _random_mail(rng: random.Random) -> bytes:
    pieces = [
        "From: a", "To: x, y", "to: z", "Subject:", "SUBJECT : s ", "Cc:c", "X:", " cont", "\tcont ", "none",
        ":odd", " : odd", "References: a  b", "From : second", " nb: x", "Subject:a:b", "\x1fq: r",
        "In-Reply-To: i ", "code: zz", "raw_body: yy", "Date: 1 Jan 2001 1:2:3", "K: é中",
    ]
    ends = ["\n"] * 8 + ["\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x85", " ", "\n \n", "\n\t\n", "\n\n"]
    text = "".join(rng.choice(pieces) + rng.choice(ends) for _ in range(rng.randint(0, 9)))
    body = "".join(rng.choice(["x", "", " ", "y: z", "-- ", " "]) + rng.choice(ends) for _ in range(rng.randint(0, 5)))
    return (text + rng.choice(["\n", "", "\n\n"]) + body).encode() + (b"\xff" if rng.random() < 0.05 else b"")


def test_random_mails_match_plain_python(raw):
    rng = random.Random(11)
    mails = [_random_mail(rng) for _ in range(3000)]
    df = raw(*[("l", i, m) for i, m in enumerate(mails)]).repartition(8)
    got = {r["article_no"]: r for r in parse_mail(df).collect()}
    for i, mail in enumerate(mails):
        want = plain.parse(mail)
        assert (i in got) == (want is not None), mail
        if want is None:
            continue
        fields, row = want["fields"], got[i]
        assert row["raw_body"] == want["body"], mail
        for name in ("from", "subject", "in-reply-to"):
            assert row[name] == fields.get(name, [""])[0], (name, mail)
        for name, separator in (("to", ","), ("cc", ","), ("references", " ")):
            assert row[name] == plain.list_field(fields.get(name, []), separator), (name, mail)


def _bodies() -> list[str]:
    fixed = [
        "", "no patch", "---", "---\n", "---\nx\n--\n2.0", "---\nx\n-- \n", "---\nx\n-- \n2.0\n",
        "---\nx\n--              \n2.0\n\n", "DIFF --GIT a b\nx\n-- \n2.0", "text diff --git a\n--\n\n\n2.0\nrest",
        "---\nx\n-- =\n\n2.26\n", "---\n a\n- b\nc\n", "---\n a\n-b", "--- \nx\n--\n1", "> ---\n> x\n> --\n> 1",
        "---\na\n--\n1\nprose\n---\nb\n--\n2\n", "---\na\n---\nb\n--\n1\n---\nc", "diff --git x\n---\ny\n--==\n\nz",
        "a\n--\n\t2.0\n---\nq", "---\nx\n--\n", "---\nx\n--", "---\n" * 50, "diff --git a\n" * 50 + "--\n1",
    ]
    rng = random.Random(3)
    lines = ["---", "--", "-- ", "-- =", "-", "- x", "diff --git a b", "Diff --Git", "", " ", "2.0", "x", "--x", "> --", " ", "----"]
    return fixed + ["\n".join(rng.choice(lines) for _ in range(rng.randint(1, 14))) for _ in range(3000)]


def test_patches_match_the_patterns(spark):
    bodies = _bodies()
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body string").repartition(8)
    got = {r["i"]: r["code"] for r in df.select("i", extract_patches(F.col("body")).alias("code")).collect()}
    for i, body in enumerate(bodies):
        assert got[i] == plain.patches(body), repr(body)


def test_many_patch_starts_without_an_end_stay_quick(spark):
    body = "intro\n" + "diff --git a b\n+line of a patch\n" * 40_000
    df = spark.createDataFrame([(body,)], "body string")
    assert df.select(F.size(extract_patches(F.col("body"))).alias("n")).first()["n"] == 0


def test_a_three_megabyte_body(spark):
    body = "---\n" + "+ a line of the patch\n" * 140_000 + "-- \n2.40\n"
    df = spark.createDataFrame([(body,)], "body string")
    found = df.select(extract_patches(F.col("body")).alias("code")).first()["code"]
    assert found == [body.strip()]


@pytest.mark.parametrize(
    "body",
    [
        "Reported-by: nobody@example.org\nx",
        "\nSigned-off-by: Example One <one@example.org>\n",
        "signed-OFF-by:\t Two  < two@example.org > # note\nTested-by: T <t@x>",
        " Reviewed-by: Indented <i@x>\nReviewed-by:<a@x>\nAcked-by:  <b@x>\nx-by: a <>",
        "Key-by: K <k@x>\nRevıewed-by: I <i@x>\nA-by: b <c >\nA-by: b\n<c>",
    ],
)
def test_trailers_match_the_pattern(spark, body):
    df = spark.createDataFrame([(body,)], "body string")
    found = df.select(extract_trailers(F.col("body")).alias("t")).first()["t"]
    assert [tuple(t) for t in found] == plain.trailers(body)


def test_dead_letter_plan_leaves_the_parsing_out(raw):
    plan = dead_letters(raw(("l", 1, MAIL)))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "make_timestamp" not in plan


def test_a_filter_does_not_decode_twice(raw):
    plan = parse_mail(raw(("l", 1, MAIL)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_validate_utf8") + plan.count("tryValidateUTF8") == 1
    assert split_raw(raw(("l", 1, MAIL))).columns[-3:] == ["head", "body", "error"]
