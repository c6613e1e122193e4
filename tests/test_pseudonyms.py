from __future__ import annotations

import hashlib
import hmac

import pytest

from postroom.operators import hash_columns, identity_map, pseudonymised_datasets

SCHEMA = (
    "`from` string, `to` array<string>, cc array<string>, subject string,"
    " trailers array<struct<attribution:string,identification:string>>, list string"
)


def sha1(text: str) -> str:
    return hashlib.sha1(text.encode()).hexdigest()


@pytest.fixture
def mail(spark):
    return spark.createDataFrame(
        [
            ("A É <a@x>", ["b@x", " c@x", None], [""], "s", [("Acked-by", "N <n@x>"), None], "l"),
            (None, None, [], "s", None, "l"),
        ],
        SCHEMA,
    )


def test_default_columns(mail):
    full, empty = hash_columns(mail).collect()
    assert full["from"] == sha1("A É <a@x>")
    assert full["to"] == [sha1("b@x"), sha1(" c@x"), None]
    assert full["cc"] == ["da39a3ee5e6b4b0d3255bfef95601890afd80709"]
    assert full["subject"] == "s"
    assert full["trailers"][0]["attribution"] == "Acked-by"
    assert full["trailers"][0]["identification"] == sha1("N <n@x>")
    assert full["trailers"][1] is None
    assert (empty["from"], empty["to"], empty["trailers"]) == (None, None, None)


def test_missing_names_are_skipped(mail):
    with pytest.warns(UserWarning, match="nobody"):
        assert hash_columns(mail, ["nobody"], []).collect() == mail.collect()
    with pytest.warns(UserWarning, match="trailers.x"):
        hash_columns(mail, [], ["trailers.x"])


def test_types_that_cannot_be_hashed_raise(spark):
    df = spark.createDataFrame([(1, [1], "x", "l")], "n int, ns array<int>, s string, list string")
    for columns, fields in ((["n"], []), (["ns"], []), ([], ["s.f"])):
        with pytest.raises(TypeError):
            hash_columns(df, columns, fields)
    with pytest.raises(TypeError):
        identity_map(df, "n")


def test_normalised_and_keyed(spark):
    df = spark.createDataFrame([(" A@X ", "l"), ("a@x", "l")], "`from` string, list string")
    same = {r["from"] for r in hash_columns(df, ["from"], [], normalise=True).collect()}
    assert same == {sha1("a@x")}
    keyed = [r["from"] for r in hash_columns(df, ["from"], [], key="k").collect()]
    other = [r["from"] for r in hash_columns(df, ["from"], [], key="q").collect()]
    assert len(set(keyed)) == 2 and not set(keyed) & set(other) and len(keyed[0]) == 64


@pytest.mark.parametrize("key", ["k", "kéy", b"\x00\xff", "long " * 40])
def test_keyed_digests_are_hmacs(mail, key):
    raw = key.encode() if isinstance(key, str) else key

    def keyed(text):
        return hmac.new(raw, text.encode(), "sha256").hexdigest()

    full, empty = hash_columns(mail, key=key).collect()
    assert hash_columns(mail, key=key).columns == mail.columns
    assert full["from"] == keyed("A É <a@x>")
    assert full["to"] == [keyed("b@x"), keyed(" c@x"), None] and full["cc"] == [keyed("")]
    assert full["trailers"][0]["identification"] == keyed("N <n@x>")
    assert (empty["from"], empty["to"], empty["trailers"]) == (None, None, None)
    pairs = {tuple(r)[:2] for r in identity_map(mail, key=key).collect()}
    assert pairs == {("A É <a@x>", full["from"]), (None, None)}


def test_no_plan_shows_the_key(mail):
    key = "sEcReT-0123456789"
    padded = [bytes(b ^ pad for b in key.encode().ljust(64, b"\0")) for pad in (0x36, 0x5C)]
    shown = [key, key.encode().hex(), *(p.hex() for p in padded), *(p.decode() for p in padded)]
    for df in pseudonymised_datasets(mail, key=key).values():
        df.collect()
        plans = df._jdf.queryExecution().toString().lower()
        assert not [s for s in shown if s.lower() in plans]


def test_datasets(mail):
    found = pseudonymised_datasets(mail)
    assert list(found) == ["__main_dataset", "__id_map_from"]
    pairs = found["__id_map_from"]
    assert pairs.columns == ["__original_from", "from", "list"]
    assert pairs.count() == 2  # one per mail
    assert identity_map(mail.union(mail), distinct=True).count() == 2


def test_no_shuffle(mail):
    for df in pseudonymised_datasets(mail).values():
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
