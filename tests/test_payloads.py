"""Payloads without secrets, against a plain recursive walk."""

import json
import re
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

import pytest

from sievework.functions import payloads as P
from sievework.operators.acceptance import check_export, validate
from sievework.sources import files


def hidden(name, keep=()):
    words = re.sub(r"[^a-z0-9]+", "_", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()).strip("_")
    if words in P.SECRET_NAMES or set(words.split("_")) & set(P.SECRET_WORDS):
        return True
    return words not in keep and (words in P.INTERNAL_NAMES or words.startswith(P.INTERNAL_STARTS))


def names(value):
    if isinstance(value, dict):
        return {k for k in value if hidden(k)}.union(*map(names, value.values()))
    if isinstance(value, list):
        return set().union(*map(names, value))
    if isinstance(value, str) and re.match(r"\s*(https?:)?//", value):
        u = urlsplit(value.strip())
        pairs = parse_qsl(u.query, keep_blank_values=True)
        return {k for k, _ in [*pairs, *parse_qsl(u.fragment, keep_blank_values=True)] if hidden(k)}.union(*(names(v) for _, v in pairs))
    return set()


def cleaned(value, keep=()):
    if isinstance(value, dict):
        return {k: cleaned(v, keep) for k, v in value.items() if not hidden(k, keep)}
    if isinstance(value, list):
        return [cleaned(v, keep) for v in value]
    mask = lambda v: re.sub(r"(?i)(cookie|token|password|secret|security_?id)=([^&\s\"'<>]+)", r"\1=***", v)
    if isinstance(value, str) and re.match(r"\s*(https?:)?//", value):
        u = urlsplit(value)
        kept = [(k, cleaned(v) if re.match("(https?:)?//", v) else mask(v)) for k, v in parse_qsl(u.query, keep_blank_values=True) if not hidden(k) and (re.match("(https?:)?//", v) or not any(hidden(n) for n, _ in parse_qsl(v)))]
        return urlunsplit((u.scheme, u.netloc, u.path, urlencode(kept), ""))
    return mask(value) if isinstance(value, str) else value


def deep(levels):
    out = {"sessionKey": 1, "note": "token=abc rest"}
    for i in range(levels):
        out = {f"k{i}": [out, [], {"lid": {"a": [1, {"b": "}"}]}}], "plain": "x\\\"{[,:]}\"y"}
    return out


CASES = [
    {}, [], [[]], "x", 3, None, True, {"a": None}, {"accessToken": {"b": [1, {"c": 2}]}}, {"to\nken": 1, "author": "token", "tokens": 2},
    {"a": [{"encryptJobId": 1, "encryptBossId": 2, "securityId": 3, "security": 4, "securely": 5}]}, {"auth": 1}, {"a": 1, "auth": 1}, {"auth": 1, "a": {"wt2": []}},
    {"url": "https://h/p?lid=1&q=2&next=https%3A%2F%2Fx%2F%3Ftoken%3D9%26z%3D1#session=2"}, {"u": ["//h?x=1", "https://h", "http://h/?a=%E4%BD%A0+b&c="]},
    {"x": "https://a/?n=" + "https%3A%2F%2Fb%2F%3Fn%3Dhttps%253A%252F%252Fc%252F%253Fn%253Dhttps%25253A%25252F%25252Fd%25252F%25253Fsecret%25253D1"},
    {"x": "https://a/?q=token%3D5"}, {"t": "你好 \\ \" \n \t / password=a&b cookie=x;"}, {"密码": 1, "": 2, " lid ": 3}, deep(1), deep(9), deep(30),
    {"long": "\\\"" * 30_000 + "token=x", "many": [{"authToken": i, "i": i} for i in range(300)]},
]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(i, json.dumps(c, ensure_ascii=i % 2 == 0)) for i, c in enumerate(CASES)] + [(100, "{bad"), (101, None), (102, ""), (103, '{"a":1')], "i int, p string")


def test_names_at_any_depth(table):
    got = {r.i: r.k for r in table.select("i", P.secret_keys("p").alias("k")).collect()}
    assert got == {i: sorted(names(c)) for i, c in enumerate(CASES)} | dict.fromkeys((100, 101, 102, 103), [])


@pytest.mark.parametrize("keep", [(), P.PUBLIC_IDENTITIES])
def test_what_is_left(table, keep):
    got = {r.i: r.safe for r in P.safe_json(table, "p", keep=keep).collect()}
    assert {i: got[i] for i in (100, 101, 102, 103)} == dict.fromkeys((100, 101, 102, 103))
    for i, c in enumerate(CASES):
        assert json.loads(got[i]) == cleaned(c, keep), i
        assert got[i] == json.dumps(json.loads(got[i]), sort_keys=True, ensure_ascii=False, separators=(",", ":"))


def test_no_python_in_the_plan(table):
    plan = P.safe_json(table.select("i", "p", P.secret_keys("p").alias("k")), "p")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_urls_too_deep_go(spark):
    url = "https://h0/?a=1"
    for i in range(1, 8):
        url = f"https://h{i}/?" + urlencode({"n": url, "k": i})
    out = spark.createDataFrame([(url,)], "u string").select(P.safe_url("u").alias("u")).first().u
    assert out.startswith("https://h7/") and "h3" in out and "h2" not in out


def test_raw_answers_keep_public_identities(spark, tmp_path):
    raw = [json.dumps({"zpData": {"jobList": [{"encryptJobId": "a", "encryptBossId": "b", "securityId": "c", "lid": "d", "jobName": "e"}]}}), "no json", None]
    df = spark.createDataFrame([(r,) for r in raw], "p string")
    files.write_raw(df, "p", str(tmp_path / "raw"))
    assert [json.loads(r.value) for r in spark.read.text(str(tmp_path / "raw")).collect()] == [{"zpData": {"jobList": [{"encryptJobId": "a", "jobName": "e"}]}}]


def test_deliveries_with_secrets_fail(spark):
    from pyspark.sql import functions as F

    good = {c: "x" for c in "job_id title company_name salary location job_link company_industry company_scale company_stage company_link jd salary_source salary_unit boss_active_status job_valid_status proxy_type proxy_job boss_title job_type post_type recruit_type active_state title_key link_verified_at dup_group".split()}
    rows = [good, good | {"job_link": "https://h/?next=https%3A%2F%2Fx%2F%3Fauth_token%3D9"}, good | {"job_link": "//h/#lid=1"}]
    df = spark.createDataFrame(rows).withColumns({"dup_size": F.lit(1), "is_primary": F.lit(True), "salary_min": F.lit(None).cast("int"), "salary_max": F.lit(None).cast("int"), "months_per_year": F.lit(None).cast("int")})
    found = {r.id: r["count"] for r in check_export(df, F.to_timestamp(F.lit("2024-01-01"))).where("id like 'sensitive:%'").collect()}
    assert found == {"sensitive:auth_token": 1, "sensitive:lid": 1}
    found = {(r.id, r.level) for r in validate(df, {"format_version": 1, "job_count": 3, "observed_jobs": ["https://h?wt2=1"]}).where("id like 'sensitive:%'").collect()}
    assert found == {("sensitive:auth_token", "error"), ("sensitive:lid", "error"), ("sensitive:wt2", "error")}
