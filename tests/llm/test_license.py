from streamtab.llm import license
from tests.llm.helpers import nothing, odd


def ids(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["license_id"] for r in license.scan(df, license.known_licenses(spark)).orderBy("doc_id").collect()]


def test_equivalent_texts_have_one_digest(spark):
    mit = license.KNOWN["MIT"]
    changed = "\n\n" + mit.replace("Copyright (c) the authors", "COPYRIGHT 2020 Someone Else\n  (c) 2021 others").replace("sublicense", "sub-licence").upper().replace(",", " ;")
    assert ids(spark, [mit, changed, mit + " and more", mit.replace("free of charge", "for a fee")]) == ["MIT", "MIT", None, None]
    assert ids(spark, ["Released under the MIT Licence", "© x\nLicensed under CC BY-NC 4.0"]) == ["MIT-notice", "CC-BY-NC-4.0-notice"]


def test_every_known_text_finds_itself(spark):
    names = sorted(license.KNOWN)
    assert ids(spark, [license.KNOWN[n] for n in names]) == names


def test_odd_rows(spark):
    df = odd(spark, "license_id", "digest", "_clean")
    got = license.scan(df, license.known_licenses(spark))
    rows = got.collect()
    assert len(rows) == df.count() and not any(r["license_id"] for r in rows)
    assert {r["license_digest"] is None for r in rows if r["text"] is None} == {True}
    assert len({r["license_digest"] for r in rows if r["text"] in ("", " \t\n")}) == 1
    assert license.scan(nothing(spark), license.known_licenses(spark)).count() == 0
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
