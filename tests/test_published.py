"""One commit for both targets, changed-input runs, the gate inside the write, and quarantine."""

import gzip
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from callfacts import fixtures, scratch
from callfacts.operators.checks import StrictInputError
from callfacts.operators.route import NO_CLIENT, routed
from callfacts.plans import published
from callfacts.plans.job import JoinOptions
from callfacts.plans.published import run_published
from callfacts.sinks import manifest as M
from callfacts.sinks.manifest import Attempt, Files, Output, PublishConflict, current, expire, orphans, read_output, recover
from callfacts.sources import changed_dates, input_files, read_call_lines, read_calls_csv, read_chat_lines

from conftest import SF_SMALL

DATE = "2024-01-05"


def _local(path):
    return path.removeprefix("file:")


def _folder(spark, name):
    return scratch.fresh_folder(spark, "tests", name)


def _run(spark, root, **options):
    given = dict(
        calls_root=fixtures.call_folder(spark, SF_SMALL),
        chats_root=fixtures.chat_folder(spark, SF_SMALL),
        dim_table=fixtures.register_clients(spark, SF_SMALL),
    )
    return run_published(spark, root=root, **(given | options))


def _counts(spark, root):
    seen = current(spark, root)
    return seen.version, read_output(spark, root, "calls", seen).count(), read_output(spark, root, "chats", seen).count()


def _ids(df):
    return sorted(r[0] for r in df.select("id").collect())


# -- manifest ----------------------------------------------------------------


class Boom(RuntimeError):
    pass


def _failing(monkeypatch, step):
    """Make a publish die between two of its steps."""
    real_save, real_write, real_rename = Attempt.save, Files.write, Files.rename_new
    saves = []

    def save(self, df, write, *a, **k):
        if step == "first output" and not saves:
            raise Boom
        saves.append(write)
        if step == "second output" and len(saves) == 2:
            raise Boom
        return real_save(self, df, write, *a, **k)

    def write(self, text, *parts):
        if step == "half a draft":
            real_write(self, text[: len(text) // 2], *parts)
            raise Boom
        if step == "no draft":
            raise Boom
        return real_write(self, text, *parts)

    def rename(self, source, target):
        if step == "before the rename":
            raise Boom
        done = real_rename(self, source, target)
        if step == "after the rename":
            raise Boom
        return done

    monkeypatch.setattr(Attempt, "save", save)
    monkeypatch.setattr(Files, "write", write)
    monkeypatch.setattr(Files, "rename_new", rename)


STEPS = ["first output", "second output", "no draft", "half a draft", "before the rename", "after the rename"]


@pytest.mark.parametrize("step", STEPS)
def test_a_failure_between_any_two_steps_leaves_both_old_or_both_new(spark, monkeypatch, step):
    root = _folder(spark, "manifest")
    _run(spark, root, partition=DATE)
    old = _counts(spark, root)
    with monkeypatch.context() as m:
        _failing(m, step)
        with pytest.raises(Boom):
            _run(spark, root)
    now = _counts(spark, root)
    if step == "after the rename":
        assert now[0] == 2 and now[1] > old[1] and now[2] > old[2]
    else:
        assert now == old
    left = orphans(spark, root, min_age_s=0)
    assert bool(left) == (step not in ("first output", "after the rename"))
    assert orphans(spark, root) == []  # a publisher at work would look the same
    assert recover(spark, root, min_age_s=0) == left and orphans(spark, root, min_age_s=0) == []
    assert _counts(spark, root) == now
    _run(spark, root)  # and the next run works
    assert _counts(spark, root)[0] == now[0] + 1


def test_a_version_is_published_once(spark):
    root = _folder(spark, "race")
    schema = spark.range(1).schema
    first, second = Attempt(spark, root), Attempt(spark, root)
    one, two = (a.save(spark.range(n), "t") for a, n in ((first, 3), (second, 4)))
    assert first.publish({"t": Output(schema, {"all": [one]})}, expect=0).version == 1
    with pytest.raises(PublishConflict):
        second.publish({"t": Output(schema, {"all": [two]})}, expect=0)
    assert read_output(spark, root, "t").count() == 3
    assert second.publish({"t": Output(schema, {"all": [two]})}).version == 2  # whole output: the last one wins
    assert read_output(spark, root, "t").count() == 4
    assert read_output(spark, root, "t", current(spark, root, 1)).count() == 3  # old versions stay readable


def test_a_publisher_that_loses_the_rename_takes_the_next_number(spark, monkeypatch):
    root, schema = _folder(spark, "lost"), spark.range(1).schema
    mine, other = Attempt(spark, root), Attempt(spark, root)
    a, b = mine.save(spark.range(2), "t"), other.save(spark.range(5), "u")
    real = Files.rename_new

    def late(self, source, target):
        monkeypatch.setattr(Files, "rename_new", real)
        other.publish({"u": Output(schema, {"all": [b]})})  # somebody else is faster
        return real(self, source, target)

    monkeypatch.setattr(Files, "rename_new", late)
    new = mine.publish({"t": Output(schema, {"all": [a]})})
    assert new.version == 2 and sorted(new.outputs) == ["t", "u"]  # and keeps what the other one published
    assert not [n for n in Files(spark, root).names(M.MANIFESTS) if n.startswith(".")]


def test_expire_keeps_the_files_of_the_versions_that_stay(spark):
    root = _folder(spark, "expire")
    for partition in (DATE, "2024-01-06", DATE):
        _run(spark, root, partition=partition)
    before = _counts(spark, root)
    gone = expire(spark, root, 1, min_age_s=0)
    assert len(gone) == 1 and _counts(spark, root) == before  # the first run's date was replaced by the third
    with pytest.raises(ValueError):
        expire(spark, root, 0)
    with pytest.raises(KeyError, match="has no output 'nothing'"):
        read_output(spark, root, "nothing")


def test_naming_a_date_replaces_that_date_only(spark):
    root = _folder(spark, "dates")
    whole = _run(spark, root)
    first = current(spark, root)
    again = _run(spark, root, partition=[DATE])
    second = current(spark, root)
    assert again.dates == {"calls": [DATE], "chats": [DATE]} and whole.version + 1 == again.version
    for t in ("calls", "chats"):
        a, b = first.outputs[t].parts, second.outputs[t].parts
        assert a.keys() == b.keys() and [d for d in a if a[d] != b[d]] == [DATE]
        assert _ids(read_output(spark, root, t, first)) == _ids(read_output(spark, root, t, second))


# -- changed input -----------------------------------------------------------


def _landed(spark):
    calls, chats = _folder(spark, "landed-calls"), _folder(spark, "landed-chats")
    for kind, source, target in (("csv", fixtures.call_folder, calls), ("json", fixtures.chat_folder, chats)):
        shutil.copytree(_local(source(spark, SF_SMALL)), _local(target), ignore=shutil.ignore_patterns("*.crc"))
    return dict(calls_root=calls, chats_root=chats, changed_only=True)


def _expected(spark, facts):
    dim = fixtures.clients_frame(spark, SF_SMALL)
    return sorted(r[0] for r in facts.join(dim, facts.clientId.try_cast("bigint") == dim.id).select(facts.id).collect())


def test_unchanged_input_is_not_read_and_a_late_file_redoes_its_date(spark, monkeypatch):
    root, given = _folder(spark, "changed"), _landed(spark)
    first = _run(spark, root, **given)
    assert first.version == 1 and len(first.dates["calls"]) > 5
    with monkeypatch.context() as m:
        for reader in ("read_calls_csv", "read_chats_json", "read_call_lines", "read_chat_lines"):
            m.setattr(published, reader, lambda *a, **k: pytest.fail("a fact was read"))
        again = _run(spark, root, **given)
    assert again.version == 1 and again.dates == {"calls": [], "chats": []} and again.counts == {}
    assert not orphans(spark, root, min_age_s=0)  # nothing is left of a run that had nothing to do

    late = f"{_local(given['calls_root'])}/date={DATE}/late.csv"
    with open(late, "w") as f:
        f.write("900001,1,2024-01-05 10:00:00,2024-01-05 10:01:00\n")
    before = current(spark, root)
    third = _run(spark, root, **given)
    assert third.dates == {"calls": [DATE], "chats": []} and third.counts["calls"]["rows"] < first.counts["calls"]["rows"] / 5
    seen = current(spark, root)
    assert [d for d, f in seen.outputs["calls"].parts.items() if f != before.outputs["calls"].parts[d]] == [DATE]
    assert seen.outputs["chats"] == before.outputs["chats"]
    facts = read_calls_csv(spark, given["calls_root"])
    assert _ids(read_output(spark, root, "calls")) == _expected(spark, facts) and 900001 in _ids(read_output(spark, root, "calls"))


def test_changed_and_vanished_files_and_dates(spark):
    root, given = _folder(spark, "vanish"), _landed(spark)
    _run(spark, root, **given)
    calls = _local(given["calls_root"])
    dates = sorted(d for d in os.listdir(calls) if d.startswith("date="))
    shutil.rmtree(f"{calls}/{dates[0]}")  # a test's own folder
    [part] = [n for n in os.listdir(f"{calls}/{dates[1]}") if n.endswith(".csv")][:1]
    with open(f"{calls}/{dates[1]}/{part}", "a") as f:
        f.write("900002,1,2024-01-02 10:00:00,2024-01-02 10:01:00\n")
    os.utime(f"{calls}/{dates[1]}/{part}", (time.time() + 5, time.time() + 5))
    again = _run(spark, root, **given)
    assert again.gone["calls"] == [dates[0][5:]] and again.dates["calls"] == [dates[1][5:]]
    assert dates[0][5:] not in current(spark, root).outputs["calls"].parts
    assert _ids(read_output(spark, root, "calls")) == _expected(spark, read_calls_csv(spark, given["calls_root"]))


def test_a_changed_dimension_or_setting_redoes_every_date(spark):
    root, given = _folder(spark, "dim-changed"), _landed(spark)
    first = _run(spark, root, **given)
    fixtures.clients_frame(spark, SF_SMALL).withColumn("name", F.concat("name", F.lit("!"))).createOrReplaceTempView("dim_new")
    second = _run(spark, root, dim_table="dim_new", **given)
    assert second.dates == first.dates
    assert read_output(spark, root, "calls").where("name NOT LIKE '%!'").count() == 0
    third = _run(spark, root, dim_table="dim_new", time_rule="fixed", **given)
    assert third.dates == first.dates
    assert not any(_run(spark, root, dim_table="dim_new", time_rule="fixed", **given).dates.values())


def test_the_list_of_files_never_runs_ahead_of_the_outputs(spark, monkeypatch):
    root, given = _folder(spark, "ledger"), _landed(spark)
    with monkeypatch.context() as m:
        _failing(m, "before the rename")
        with pytest.raises(Boom):
            _run(spark, root, **given)
    assert len(_run(spark, root, **given).dates["calls"]) > 5  # the failed run's list is not believed


def test_a_run_that_was_overtaken_raises(spark, monkeypatch):
    root, given = _folder(spark, "overtaken"), _landed(spark)
    _run(spark, root, **given)
    with open(f"{_local(given['calls_root'])}/date={DATE}/late.csv", "w") as f:
        f.write("900001,1,2024-01-05 10:00:00,2024-01-05 10:01:00\n")
    real, once = Attempt.publish, []

    def publish(self, *a, **k):
        if not once:
            once.append(True)
            _run(spark, root, **given)
        return real(self, *a, **k)

    monkeypatch.setattr(Attempt, "publish", publish)
    with pytest.raises(PublishConflict):
        _run(spark, root, **given)
    assert current(spark, root).version == 2


def test_changed_dates_by_size_time_and_presence(spark):
    cols = "kind string, date string, path string, size long, changed timestamp"
    t = "2024-01-01 00:00:00"
    rows = [("c", "d1", "a", 1), ("c", "d2", "b", 1), ("c", "d3", "c", 1), ("c", "d3", "x", 1), ("c", "d4", "d", 1)]
    make = lambda rs: spark.createDataFrame([(*r, None) for r in rs], cols).withColumn("changed", F.lit(t).cast("timestamp"))
    now = [("c", "d1", "a", 1), ("c", "d2", "b", 2), ("c", "d3", "c", 1), ("c", "d5", "e", 1), ("h", "d1", "a", 1)]
    got = {(r.kind, r.date): r.files for r in changed_dates(make(rows), make(now)).collect()}
    assert got == {("c", "d2"): 1, ("c", "d3"): 1, ("c", "d4"): 0, ("c", "d5"): 1, ("h", "d1"): 1}


def test_the_file_list_reads_no_content_and_skips_hidden_files(spark):
    root = _folder(spark, "list")
    os.makedirs(f"{_local(root)}/date={DATE}")
    for name in ("a.csv", "_meta", ".hidden"):
        with open(f"{_local(root)}/date={DATE}/{name}", "w") as f:
            f.write("x" * 100)
    files = input_files(spark, "calls", root)
    assert [(r.date, r.path.rsplit("/", 1)[1], r.size) for r in files.collect()] == [(DATE, "a.csv", 100)]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()


# -- gate --------------------------------------------------------------------


def _records_read(spark, work):
    """Input records of all stages that ``work`` runs, from Spark's own status store."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def total():
        empty = spark._jvm.java.util.Collections.emptyList()
        stages = store.stageList(empty, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), empty)
        return sum(stages.apply(i).inputRecords() for i in range(stages.size()))

    before = total()
    work()
    return total() - before


def test_a_strict_run_reads_each_fact_once(spark):
    calls = fixtures.calls_frame(spark, SF_SMALL).count()
    chats = fixtures.chats_frame(spark, SF_SMALL).count()
    clients = fixtures.clients_frame(spark, SF_SMALL).count()
    strict = dict(join=JoinOptions(strict=True, strategy="spark"), strict_dates=True, allow_empty=True)
    read = _records_read(spark, lambda: _run(spark, _folder(spark, "gate"), **strict))
    assert calls + chats <= read <= calls + chats + 2 * clients


def test_a_refused_run_leaves_the_last_version_and_reports_every_rule(spark):
    root = _folder(spark, "refused")
    _run(spark, root, partition=DATE)
    before = _counts(spark, root)
    dirty = dict(calls_root=fixtures.dirty_call_folder(spark, SF_SMALL))
    with pytest.raises(StrictInputError, match="clientId is not a number .*nothing was published") as refused:
        _run(spark, root, join=JoinOptions(strict=True), **dirty)
    assert _counts(spark, root) == before
    calls = fixtures.dirty_calls_frame(spark, SF_SMALL)
    bad = calls.where("clientId IS NOT NULL AND try_cast(clientId AS BIGINT) IS NULL").count()
    assert refused.value.report["clientId is not a number"] == bad > 0
    assert refused.value.report["rows"] == calls.count()
    with pytest.raises(StrictInputError, match="message date is unreadable"):
        _run(spark, root, chats_root=fixtures.dirty_chat_folder(spark, SF_SMALL), strict_dates=True)
    with pytest.raises(StrictInputError, match="quarantined"):
        _run(spark, root, quarantine=True, most_quarantined=0.1, **dirty)
    assert _counts(spark, root) == before


# -- quarantine --------------------------------------------------------------


def test_target_and_quarantine_equal_the_input(spark):
    root = _folder(spark, "quarantine")
    dirty = fixtures.dirty_call_folder(spark, SF_SMALL)
    done = _run(spark, root, quarantine=True, calls_root=dirty)
    kept, held = (read_output(spark, root, n) for n in ("calls", "calls_quarantine"))
    every = fixtures.dirty_calls_frame(spark, SF_SMALL)
    assert sorted(_ids(kept) + _ids(held)) == _ids(every)
    assert done.counts["calls"]["quarantined"] == held.count() and done.counts["calls"]["rows"] == every.count()
    rows = held.collect()
    assert all(r.reasons and r.raw and r.raw.startswith(f"{r.id},") for r in rows)
    for reason in {x for r in rows for x in r.reasons}:
        assert done.counts["calls"][reason] == sum(reason in r.reasons for r in rows)
    # quarantined lines can be sent again as they are
    again = _folder(spark, "again")
    held.select("raw").write.text(f"{again}/date={DATE}")
    assert _ids(read_calls_csv(spark, again)) == _ids(held)


@pytest.mark.parametrize("strategy", ["broadcast", "hash", "shuffle", "split"])
def test_routing_is_the_same_in_every_join_tier(spark, strategy):
    dim = fixtures.clients_frame(spark, SF_SMALL).limit(40)
    lines = read_call_lines(spark, fixtures.dirty_call_folder(spark, SF_SMALL), raw_column="raw", corrupt_column="bad").drop("bad")
    from callfacts.functions.rules import fact_rules

    got = routed(lines, dim, fact_rules(), strategy=strategy, hot_key_rows=3)
    rows = {r.id: (r.route, r.name, tuple(r.reasons)) for r in got.collect()}
    names = {r.id: r.name for r in dim.collect()}
    assert len(rows) == lines.count()
    for r in lines.collect():
        key = int(r.clientId) if r.clientId and not r.clientId.startswith("x") else None
        route, name, reasons = rows[r.id]
        assert name == names.get(key)
        assert (NO_CLIENT in reasons) == (key is not None and key not in names)
        assert (route == "target") == (not reasons)


def test_facts_without_a_readable_key_never_match_and_spread(spark):
    """A key that cannot be read stands under a hash; a client of just that number must not match."""
    calls = spark.createDataFrame([(1, "x"), (2, None), (3, "7")], "id long, clientId string")
    from callfacts.operators.enrich import join_client

    hashes = calls.select(F.xxhash64("id", "clientId").alias("id")).collect()
    dim = spark.createDataFrame([(r.id, "wrong") for r in hashes] + [(7, "right"), (None, "none")], "id long, name string")
    for strategy in ("broadcast", "shuffle", "split"):
        got = join_client(calls, dim, strategy=strategy, keep_unmatched="found").collect()
        assert {(r.id, r.name, r.found) for r in got} == {(1, None, False), (2, None, False), (3, "right", True)}


def test_lines_keep_their_text_and_parse_as_the_readers_do(spark):
    root = _folder(spark, "lines")
    os.makedirs(f"{_local(root)}/date={DATE}")
    lines = ["1,7,2024-01-05 10:00:00,2024-01-05 10:01:00", "", "  ", "2,x,soon,2024-01-05T10:01:00", '3,"a,b",,', "zz,1,,"]
    with gzip.open(f"{_local(root)}/date={DATE}/a.csv.gz", "wt") as f:
        f.write("\n".join(lines))
    whole = read_call_lines(spark, root, DATE, raw_column="raw", corrupt_column="bad")
    plain = read_calls_csv(spark, root, DATE, corrupt_column="bad")
    order = lambda df: sorted(df.select("id", "clientId", "startAt", "endAt", "date", "bad").collect(), key=str)
    assert order(whole) == order(plain)
    assert sorted(r.raw for r in whole.collect()) == sorted(x for x in lines if x.strip())
    chats = _folder(spark, "chat-lines")
    os.makedirs(f"{_local(chats)}/date={DATE}")
    with open(f"{_local(chats)}/date={DATE}/a.json", "w") as f:
        f.write('{"id":1,"clientId":"7","messages":[{"id":1,"text":"t","sendAt":"01/02/2024"}]}\n{"id":"x","clientId":"8"}\nnot json\n')
    rows = read_chat_lines(spark, chats, raw_column="raw", corrupt_column="bad").collect()
    assert [(r.clientId, bool(r.bad)) for r in sorted(rows, key=lambda r: r.raw)] == [(None, True), ("8", True), ("7", False)]


def test_options_that_exclude_each_other(spark):
    root = _folder(spark, "options")
    with pytest.raises(ValueError, match="two names"):
        _run(spark, root, calls_table="t", chats_table="t")
    with pytest.raises(ValueError, match="choose one"):
        _run(spark, root, quarantine=True, strict_dates=True)
    with pytest.raises(ValueError, match="finds the dates itself"):
        _run(spark, root, changed_only=True, partition=DATE)


def test_command_line_of_a_published_run(spark, capsys):
    from callfacts.__main__ import main

    root, given = _folder(spark, "cli"), _landed(spark)
    fixtures.register_clients(spark, SF_SMALL)
    args = ["--tableSuffix", "_stg", "--publish", "manifest", "--staging-root", root]
    args += ["--calls-root", given["calls_root"], "--chats-root", given["chats_root"], "--changed-only", "--quarantine"]
    assert main(args) == 0 and '"version": 1' in capsys.readouterr().out
    assert main(args) == 0 and '"calls_stg": []' in capsys.readouterr().out
    assert sorted(current(spark, root).outputs) == ["calls_stg", "calls_stg_quarantine", "chats_stg", "chats_stg_quarantine"]
    for wrong in (["--tableSuffix", "_s"], ["--tableSuffix", "_s", "--changed-only"], [*args, "--catalog"], args[:4]):
        with pytest.raises(SystemExit):
            main(wrong)
