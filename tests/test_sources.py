import os
import tempfile

import pytest
from pyspark.sql import functions as F

from eventloom.operators.lookup import mask_rows
from eventloom.plans.flow import definition_templates
from eventloom.schema import as_events
from eventloom.session import shared_dir
from eventloom.sources.config import read_event_defs, read_hide_rules, read_patterns, read_rules, read_settings, rule_list
from eventloom.sources.envelopes import read_envelopes
from eventloom.sources.event_logs import read_documents, read_event_logs, split_documents, split_log_files
from eventloom.sources.kafka import kafka_options
from eventloom.sources.committed import commit, read_committed, stale_attempts, write_committed
from eventloom.sources.sinks import write_events
from eventloom.plans.catalog.rules import RULE_FILE, RULES


def put(name, text):
    path = os.path.join(tempfile.mkdtemp(prefix="eventloom-test-"), name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_rules_file(spark):
    path = put("rules.xml", RULE_FILE)
    got = rule_list(read_rules(spark, path))
    assert [r.rule_no for r in got] == list(range(1, 8))
    assert got[3] == RULES[3] and got[4] == RULES[4]
    assert [r.uei for r in got] == [r.uei for r in RULES]
    hide = [(r.type, r.expression) for r in read_hide_rules(spark, path).orderBy("rule_no").collect()]
    assert hide == [("substr", "did purchase"), ("regex", "amount [0-9]*7 ")]
    assert read_settings(spark, path)["discard_uei"] == "DISCARD"


DEFS = """<events xmlns="urn:x"><event><mask><maskelement><mename>id</mename><mevalue>.1.3</mevalue></maskelement>
<maskelement><mename>generic</mename><mevalue>5</mevalue><mevalue>6</mevalue></maskelement>
<varbind><vbnumber>1</vbnumber><vbvalue>~a.*</vbvalue></varbind></mask>
<uei>u/1</uei><event-label>One</event-label><descr>&lt;p>%parm[#1]%&lt;/p></descr>
<logmsg dest="logonly">m %nodelabel%</logmsg><severity>Major</severity>
<alarm-data reduction-key="%uei%:%nodeid%" alarm-type="1" auto-clean="false"><update-field field-name="severity" update-on-reduction="true"/></alarm-data>
<varbindsdecode><parmid>parm[#1]</parmid><decode varbindvalue="1" varbinddecodedstring="up"/><decode varbindvalue="2" varbinddecodedstring="down"/></varbindsdecode>
</event><event><uei>u/2</uei><descr>plain</descr><severity>Normal</severity></event></events>"""


def test_event_definitions(spark):
    first, second = put("b.xml", DEFS), put("a.xml", DEFS.replace("u/", "v/"))
    rows = read_event_defs(spark, [first, second]).orderBy("def_no").collect()
    assert [(r.def_no, r.uei) for r in rows] == [(1, "u/1"), (2, "u/2"), (3, "v/1"), (4, "v/2")]
    r = rows[0]
    assert r.logmsg.dest == "logonly" and r.alarm_data.reduction_key == "%uei%:%nodeid%"
    assert r.alarm_data.update_fields[0].field == "severity" and r.decodes == {"parm[#1]": {"1": "up", "2": "down"}}
    masks = sorted((m.def_no, m.element, m.val) for m in mask_rows(read_event_defs(spark, first)).collect())
    assert masks == [(1, "generic", "5"), (1, "generic", "6"), (1, "id", ".1.3"), (1, "varbind#1", "~a.*")]
    assert set(definition_templates(read_event_defs(spark, first))) == {"<p>%parm[#1]%</p>", "m %nodelabel%", "%uei%:%nodeid%"}


def test_pattern_table(spark):
    path = put("p.properties", "#x\nA=<%{INTEGER:n}>%{STRING:m}\nB=%{STRING:m}\nC=%{STRING:m}\n")
    assert [(r.pattern_no, r.name) for r in read_patterns(spark, path).orderBy("pattern_no").collect()] == [(1, "A"), (2, "B")]


def test_envelope(spark):
    xml = ('<syslog-message-log source-address="198.51.100.23" source-port="40112" system-id="relay-b" location="Hall 3">\n'
           '<messages timestamp="2031-05-06T07:08:09Z">PDQ2PmRpc2s6ID\ngxJSBmdWxsAAA=</messages></syslog-message-log>')
    rows = read_envelopes(spark.createDataFrame([(xml,), ("junk",)], "value string")).collect()
    assert (rows[0].source_address, rows[0].source_port, rows[0].system_id, rows[0].location, rows[0].raw) == (
        "198.51.100.23", 40112, "relay-b", "Hall 3", "<46>disk: 81% full")
    assert rows[1].raw is None


def test_event_log_file(spark):
    good = '<log><events><event uuid="a"><uei>u1</uei></event><event><uei>u2</uei></event></events></log>'
    bad = "<log><events><event><uei>x</uei></evnt></events></log>"
    prefixed = '<n:log xmlns:n="urn:x"><n:events><n:event><n:uei>u3</n:uei></n:event></n:events></n:log>'
    path = put("events.txt", "\n".join([good, bad, prefixed, good.replace("u1", "u4").replace("u2", "u5")]))
    events, rejects = read_event_logs(spark, path)
    assert [r.uei for r in events.orderBy("doc_no", "seq").collect()] == ["u1", "u2", "u3", "u4", "u5"]
    assert rejects.count() == 1


@pytest.mark.parametrize("size", [7, 40, 64, 1000])
@pytest.mark.parametrize("tail", ["", "\n  ", " left <log> over", "</", "</log"])
def test_event_log_file_in_splits(spark, size, tail):
    """Documents across any number of splits, with closing tags on their borders, as from the whole file."""
    docs = ['<log><events><event><uei>é"log>"&lt;/log&gt;</uei></event></events></log>', "junk </catalog> <log></log>",
            '<n:log xmlns:n="urn:x"><n:events><n:event><n:uei>b</n:uei></n:event></n:events></n:log>', "<log>&broken</log>", " <x></log>"]
    path = put("split.txt", "\n".join(docs * 4) + tail)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    want = sorted(tuple(r) for r in split_documents(
        spark.read.text(path, wholetext=True), "value", []).select("doc_no", "doc").collect())
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = sorted((r.doc_no, r.doc) for r in split_log_files(spark, path).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert got == want


def test_event_times(spark):
    """ISO and long times, a missing one, and one that is neither."""
    times = ["2031-05-06T07:08:09Z", "Tuesday, May 6, 2031 7:08:09 AM UTC", None, "some day"]
    text = "".join(f"<log><events><event><uei>u</uei>{f'<time>{t}</time>' if t else ''}</event></events></log>" for t in times)
    events, _ = read_documents(spark.createDataFrame([(text,)], "t string"), "t", [])
    got = [r.t for r in events.orderBy("doc_no").select(F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("t")).collect()]
    assert got == ["2031-05-06 07:08:09"] * 2 + [None, None]


def test_writer_contract(spark):
    """Nothing to store writes nothing; one or two events are one write."""
    def events(*dests):
        rows = [(d,) for d in dests]
        return as_events(spark.createDataFrame(rows, "d string").select(
            F.lit("u").alias("uei"), F.struct(F.col("d").alias("dest"), F.lit("m").alias("content")).alias("logmsg")))

    path = shared_dir(spark, "test-table")
    assert write_events(events(), path) is False
    assert write_events(events("donotpersist"), path) is False
    assert write_events(events("logndisplay"), path) is True
    assert write_events(events("logndisplay", "logndisplay", "suppress"), path) is True
    assert spark.read.parquet(path).count() == 3


def test_repeated_batch_replaces_itself(spark):
    path = shared_dir(spark, "test-batches")
    df = as_events(spark.range(2).select(F.lit("u").alias("uei"), F.struct(
        F.lit("logonly").alias("dest"), F.lit("m").alias("content")).alias("logmsg")))
    for batch in (1, 1, 2):
        write_events(df, path, batch)
    assert spark.read.parquet(path).count() == 4


def test_kafka_options():
    assert kafka_options("h:1", ["a", "b"], "g")["subscribe"] == "a,b"
    assert kafka_options("h:1", "a", "g")["startingOffsets"] == "earliest"
    for servers, topic, group in (("", "a", "g"), ("h", "a", ""), ("h", [], "g")):
        with pytest.raises(ValueError):
            kafka_options(servers, topic, group)


def test_batches_count_once_and_whole(spark, tmp_path):
    path, frame = str(tmp_path / "out"), lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long")
    schema = frame(1).schema
    assert read_committed(spark, path, schema).count() == 0 and stale_attempts(spark, path).count() == 0
    assert write_committed(frame(1, 2), path, 0) is True
    assert write_committed(frame(1, 2), path, 0) is False
    assert write_committed(frame(), path, 1) is True

    def dies(k):
        raise RuntimeError("lost")

    # A write that fails in a task, and one whose driver dies before the manifest entry.
    with pytest.raises(Exception, match="lost"):
        write_committed(frame(3, 4).select(F.udf(dies, "long")("id").alias("id")), path, 2)
    frame(3).write.parquet(f"{path}/data/batch_id=2/attempt=dead")
    read = lambda: sorted((r.id, r.batch_id) for r in read_committed(spark, path, schema).collect())
    assert read() == [(1, 0), (2, 0)]
    assert [(r.batch_id, r.attempt) for r in stale_attempts(spark, path).collect()] == [(2, "dead")]
    assert write_committed(frame(3, 4), path, 2) is True
    # Of two writers of one batch the first to commit counts.
    frame(9).write.parquet(f"{path}/data/batch_id=2/attempt=late")
    assert commit(spark, path, 2, "late") is False
    assert read() == [(1, 0), (2, 0), (3, 2), (4, 2)]
    with pytest.raises(ValueError, match="attempt"):
        write_committed(frame(1).withColumnRenamed("id", "Attempt"), path, 3)
