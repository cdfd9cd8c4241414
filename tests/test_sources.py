import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import snapshots
from tidemark.sources import artifacts, bars, html, json_paths, observations

D = dt.date


@pytest.mark.parametrize(
    "title,want",
    [
        ("January 29-30 Meeting - 2019", D(2019, 1, 30)), ("April/May 30-1 Meeting - 2019", D(2019, 5, 1)),
        ("December/January 31-1 Meeting - 2019", D(2020, 1, 1)), ("Jan 5 Meeting - 1960", D(1960, 1, 5)),
        ("March 15 (unscheduled) Meeting - 2020", None), ("January 9 Conference Call - 2008", None),
        ("March 19 (notation vote) - 2020", None), ("March 17-18 (cancelled) Meeting - 2020", None),
        ("March 17-18 (canceled) Meeting - 2020", None), ("October 4 (unscheduled) - 2019", None),
        ("February 30 Meeting - 2019", None), ("Foo 3 Meeting - 2019", None), ("Meetings of note", None), ("", None),
    ],
)
def test_meeting_headings(spark, title, want):
    got = [r.event_date for r in html.heading_days(spark.createDataFrame([(title,)], "title string")).collect()]
    assert got == ([want] if want else [])


def test_headings_lose_tags_space_and_entities(spark):
    page = "<h4 id='a'><a href='#'>January\n 29-30</a> Meeting&nbsp;- 2019</h4><h3>no</h3><H5>Q&amp;A &lt;b&gt;</H5>"
    got = html.headings(spark.createDataFrame([(1, page)], "id int, html string"), "id").orderBy("position").collect()
    assert [r.title for r in got] == ["January 29-30 Meeting - 2019", "Q&A <b>"]
    assert html.meeting_days(spark.createDataFrame([(1, page)], "id int, html string"), "id").first().event_date == D(2019, 1, 30)


def test_panel_pages(spark):
    row = '<div class="row fomc-meeting{x}"><div class="fomc-meeting__month col"><strong>{m}</strong></div><div class="fomc-meeting__date c">{d}</div></div>'
    page = ("<p>intro</p><h4>2022 FOMC Meetings</h4>" + row.format(x="", m="January", d="25-26*") + row.format(x=" last", m="Apr/May", d="30-1")
            + "<h4>2023 FOMC Meetings</h4>" + row.format(x="", m="June", d="13-14"))
    df = spark.createDataFrame([(1, page)], "id int, html string")
    every = sorted(r.event_date for r in html.panel_meeting_days(df, "id").collect())
    assert every == [D(2022, 1, 26), D(2022, 5, 1), D(2023, 6, 14)]
    assert html.panel_meeting_days(df, "id", F.col("year") == 2023).count() == 1


def test_pages_split_and_join(spark):
    body = lambda v: json.dumps({"observations": [{"date": "2020-01-01", "value": v, "realtime_start": "2020-02-01", "realtime_end": "9999-12-31"}]})
    pages = spark.createDataFrame([("s", 100, body("2")), ("s", 0, body("1"))], "series string, offset int, body string")
    text = observations.concat_pages(pages, "series")
    assert [r.offset for r in observations.split_pages(text, "series").orderBy("page").collect()] == [0, 100]
    assert [r.value for r in observations.observations(text, "series").orderBy("ordinal").collect()] == ["1", "2"]
    bad = spark.createDataFrame([("s", observations.BOUNDARY + "nope\n{}")], "series string, payload string")
    with pytest.raises(Exception, match="bad page header"):
        observations.split_pages(bad, "series").collect()


def test_page_files_are_read_by_several_tasks(spark, folder):
    values = lambda o: [{"date": f"2020-01-{d:02}", "value": f"{o}.{d}", "realtime_start": "2020-02-01", "realtime_end": "9999-12-31"} for d in range(1, 1 + o % 7)]
    pages = [(s, o, json.dumps({"observations": values(o)})) for s in ("a b", "7") for o in range(60)]
    frame = spark.createDataFrame(pages[::-1], "series string, offset int, body string").repartition(5)
    observations.write_pages(frame, "series", f"{folder}/pages")
    text = observations.concat_pages(frame, "series")
    want = {s: [(r.value, r.date) for r in observations.observations(text, "series").where(F.col("series") == s).orderBy("ordinal").collect()] for s in ("a b", "7")}
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in (61, 333, 1000, 1 << 20):  # the boundary falls on a cut somewhere
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            spark.conf.set("spark.sql.files.openCostInBytes", str(size))
            got = observations.read_observations(spark, f"{folder}/pages", "series")
            if size < 1000:
                assert got.rdd.getNumPartitions() > 20
            for s, rows in want.items():
                assert [(r.value, r.date) for r in got.where(F.col("series") == s).orderBy("ordinal").collect()] == rows
            heads = observations.read_pages(spark, f"{folder}/pages", "series").where("series = '7'").orderBy("ordinal")
            assert [r.offset for r in heads.collect()] == list(range(60))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    spark.createDataFrame([("x", "offset=1\n{}"), ("x", observations.BOUNDARY + "nope\n{}")], "series string, t string").coalesce(1).write.partitionBy("series").text(f"{folder}/bad")
    with pytest.raises(Exception, match="bad page header in x"):
        observations.read_pages(spark, f"{folder}/bad", "series").collect()
    with pytest.raises(Exception, match="no offset or body"):
        observations.write_pages(spark.createDataFrame([("x", None, "{}")], "series string, offset int, body string"), "series", f"{folder}/none")
    empty = spark.createDataFrame([("x", 1, "")], "series string, offset int, body string")
    observations.write_pages(empty, "series", f"{folder}/empty")
    assert observations.read_observations(spark, f"{folder}/empty", "series").count() == 0


def test_bar_documents(spark):
    full = {"date": "2024-01-02T00:00:00.000Z", **{f: 1.5 for f in bars.FIELD_MAP}, "more": 1}
    docs = spark.createDataFrame(
        [("spy", json.dumps([full, {**full, "date": "2024-01-06T00:00:00Z", "open": None}])), ("a", "{}"), ("b", "[]"), ("c", "no json"),
         ("d", json.dumps([{"date": "2024-01-02"}]))], "symbol string, payload string")
    errors = {r.symbol: r.error for r in bars.document_errors(docs, ["symbol"]).collect()}
    assert set(errors) == {"a", "b", "c", "d"} and errors["b"] == "empty" and errors["d"].startswith("missing fields")
    rows = bars.bar_rows(docs, ["symbol"])
    spine = spark.createDataFrame([(D(2024, 1, 2),)], "date date")
    good = bars.normalize_bars(rows, spine).collect()
    assert [(r.symbol, r.volume, r.adj_close) for r in good] == [("SPY", 1, 1.5)]
    assert [r.date for r in bars.bar_rejects(rows, spine).collect()] == [D(2024, 1, 6)]
    assert bars.bar_number_errors(rows, spine).count() == 0  # off-spine rows are not looked at


def test_close_only_keeps_negatives_and_skips_the_unreadable(spark):
    obs = spark.createDataFrame([("2024-01-02", "-37.63"), ("2024-01-02", "."), ("2024-01-02", "x"), ("2024-01-02", "inf"), ("2024-01-06", "1")], "date string, value string")
    spine = spark.createDataFrame([(D(2024, 1, 2),)], "date date")
    r = bars.normalize_close_only("wti", obs, spine).collect()
    assert [(x.symbol, x.close, x.open, x.volume) for x in r] == [("WTI", -37.63, None, None)]
    assert bars.close_only_rejects(obs, spine).count() == 1


def test_secret_keys_are_keys_only(spark):
    doc = json.dumps({"a": {"Api-Key": 1, "list": [{"my_password": "x"}]}, "note": 'say "secret": no', "token": 1})
    one = spark.createDataFrame([(doc,)], "t string")
    assert one.select(artifacts.secret_keys(F.col("t")).alias("k")).first().k == ["Api-Key", "my_password"]
    assert one.select(artifacts.secret_keys(F.col("t"), artifacts.SECRET_METADATA_KEY).alias("k")).first().k == ["Api-Key", "my_password", "token"]


def test_artifacts_are_listed_with_their_errors(spark, folder):
    for name, text in {"manifest_a.json": '{"build_id":"A","started_at":"2024"}', "manifest_b.json": "{", "manifest_c.json": "[]", "run_x.json": '{"run_id":"X"}',
                       "other.json": "{}", "manifest_d.json": '{"password":1}'}.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)
    docs = artifacts.read_artifacts(spark, folder)
    got = {r.artifact_id: r.error for r in artifacts.scan(docs, "manifest").collect()}
    assert got == {"A": None, "b": "malformed JSON", "c": "root is not an object", "d": "secret-like keys: password"}
    assert [r.artifact_id for r in artifacts.scan(docs, "run_report").collect()] == ["X"]


def test_identity_metadata(spark):
    a, b = '{"b":"1","a":"2"}', '{"a":"2","b":"1"}'
    df = spark.createDataFrame([(a, b, '{"url":"u","api_key":"k","header":"Token abc"}')], "a string, b string, c string")
    r = df.select(artifacts.identity_key(F.col("a")).alias("x"), artifacts.identity_key(F.col("b")).alias("y")).first()
    c = json_paths.scrubbed(df, "c").first()
    assert r.x == r.y == b and json.loads(c.scrubbed_text) == {"url": "u", "header": "Token abc"} and c.leaks


def test_snapshot_check_order(spark):
    import hashlib

    ident = lambda s: "sha256:" + hashlib.sha256(s.encode()).hexdigest()
    side = lambda s: json.dumps({"sha256": hashlib.sha256(s.encode()).hexdigest()})
    entries = spark.createDataFrame(
        [(1, ident("a"), "{}"), (2, ident("b"), "{}"), (3, "bad", "{}"), (4, None, "{}"), (5, ident("e"), '{"token":1}'), (6, ident("zz"), "{}"),
         (7, ident("g"), "{}"), (8, ident("h"), "{}"), (9, ident("i"), "{}")], "entry int, snapshot_id string, meta string")
    blobs = spark.createDataFrame(
        [(ident("a"), b"a", side("a")), (ident("b"), b"B", side("b")), (ident("g"), None, side("g")), (ident("h"), b"h", '{"secret":1}'), (ident("i"), b"i", side("x"))],
        "snapshot_id string, content binary, sidecar string")
    got = {r.entry: r.status for r in snapshots.verify(entries, blobs).collect()}
    assert got == {1: "ok", 2: "corrupt", 3: "invalid_metadata", 4: "invalid_metadata", 5: "invalid_metadata", 6: "missing", 7: "missing", 8: "invalid_metadata", 9: "invalid_metadata"}


def test_character_references(spark):
    text = "a&#8211;b&#x2013;c&eacute;&hellip;d&amp;lt;&nbsp;&bogus;&#0;&#x1F600;&#xD800; & &AMP;"
    want = "a–b–cé…d&lt;\u00a0&bogus;\ufffd\U0001f600\ufffd & &"
    assert spark.createDataFrame([(text,)], "x string").select(html.unescaped(F.col("x")).alias("t")).first().t == want


def test_secrets_behind_escapes_and_at_depth(spark):
    rows = [(r'{"api\u005fkey":1}',), ('{"o":{"api_key":1,"x":[{"token":2,"y":"Token abc"}]}}',), ('{"plain":1}',), (None,)]
    df = spark.createDataFrame(rows, "j string")
    assert [r.n for r in df.select(F.size(artifacts.secret_keys(F.col("j"))).alias("n")).limit(3).collect()] == [1, 1, 0]
    got = {r.j: (r.scrubbed_text, r.leaks) for r in json_paths.scrubbed(df, "j").collect()}
    assert [got[j] for (j,) in rows] == [("{}", False), ('{"o":{"x":[{"y":"Token abc"}]}}', True), ('{"plain":1}', False), (None, None)]


def test_sidecars_name_their_digest(spark):
    import hashlib

    d = hashlib.sha256(b"x").hexdigest()
    sides = [f'{{"sha256":"{d}"}}', f'{{"digest":"{d}"}}', '{"size":1}', '{"digest":"00"}']
    blobs = spark.createDataFrame([(f"sha256:{d}", bytearray(b"x"), s) for s in sides], "snapshot_id string, content binary, sidecar string")
    entries = spark.createDataFrame([(1, f"sha256:{d}", "{}")], "entry int, snapshot_id string, meta string")
    got = [snapshots.verify(entries, blobs.where(F.col("sidecar") == s)).first().status for s in sides]
    assert got == ["ok", "ok", "invalid_metadata", "invalid_metadata"]


def test_eligibility_reasons(spark):
    doc = lambda i, **k: (f"p{i}", "manifest", f"b{i}", "t", None, json.dumps({"build_id": f"b{i}", "schema_version": "1.1", "snapshot_capture": True, "exact_rebuild_capable": True, "snapshots": ["s"], "database_fingerprint": "f"} | k))
    rows = [doc(1), doc(2, schema_version="1.0"), doc(3, exact_rebuild_capable=False), doc(4, database_fingerprint=None), doc(5)]
    frame = spark.createDataFrame(rows, "path string, kind string, artifact_id string, started_at string, error string, text string")
    verified = spark.createDataFrame([("b1", "ok"), ("b5", "ok"), ("b5", "corrupt")], "build_id string, status string")
    got = {r.build_id: r.reason for r in artifacts.rebuild_eligibility(frame, verified).collect()}
    assert got == {"b1": None, "b2": "schema version", "b3": "not exact-rebuild capable", "b4": "no database fingerprint", "b5": "snapshot verification failed"}


def _tree(pick, depth):
    keys = ["a", "b c", "api_key", "Password", "token", "x.y", 'tok"en', "é", "database-url"]
    kind = pick.randrange(6) if depth else 9
    if kind < 3:
        return {pick.choice(keys): _tree(pick, depth - 1) for _ in range(pick.randrange(4))}
    if kind < 5:
        return [_tree(pick, depth - 1) for _ in range(pick.randrange(4))]
    return pick.choice([None, True, 1, 2.5, "s", "Token abc", 'q"\\n', ""])


def test_json_of_any_depth(spark):
    """Secret paths and scrubbed documents against plain recursion, with documents that are none."""
    import random
    import re

    pick = random.Random(4)
    broken = ["{bad", "", '{"token":1}}', '{"token":1}]', '{"a":1},{"b":2}', '{"a":1},"b":2', "[1] x", None]
    docs = [json.dumps(_tree(pick, 5)) for _ in range(150)] + ["[]", "{}", "3", '"Token x"', "null"] + broken
    df = spark.createDataFrame(list(enumerate(docs)), "id int, text string")
    secret, gone, value = (re.compile(p) for p in (artifacts.SECRET_KEY, artifacts.SECRET_METADATA_KEY, artifacts.SECRET_VALUE))

    def hits(x, path=""):
        if isinstance(x, dict):
            for k, v in x.items():
                p = f"{path}.{k}" if path else k
                yield from [p] if secret.search(k) else []
                yield from hits(v, p)
        elif isinstance(x, list):
            for i, v in enumerate(x):
                yield from hits(v, f"{path}[{i}]")

    def scrub(x, found):
        if isinstance(x, dict):
            return {k: scrub(v, found) for k, v in x.items() if not gone.search(k)}
        if isinstance(x, list):
            return [scrub(v, found) for v in x]
        found += [x] if isinstance(x, str) and value.search(x) else []
        return x

    sound = {i: json.loads(t) for i, t in enumerate(docs) if t not in broken}
    got = sorted((r.id, r.path) for r in json_paths.secret_paths(df, ["id"]).collect())
    assert got == sorted((i, p) for i, x in sound.items() for p in hits(x)) and got
    for r in json_paths.scrubbed(df).collect():
        found = []
        want = scrub(sound[r.id], found) if r.id in sound else None
        assert (r.scrubbed_text is None) == (r.id not in sound) and r.leaks == (bool(found) if r.id in sound else None)
        assert r.id not in sound or json.loads(r.scrubbed_text) == want
    assert json_paths.scrubbed(df.limit(0)).count() == 0 == json_paths.secret_paths(df.limit(0), ["id"]).count()
