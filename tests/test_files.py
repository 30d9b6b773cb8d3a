"""Loaders, sinks and the file stream on small written files."""

from pyspark.sql import functions as F

from tidemark.operators import messages as ms
from tidemark.sources import files, sinks, xml
from tidemark.streaming import refresh
from tidemark.streaming.ingest import ingest_stream, ingested

SCHEMA = "id STRING, name STRING, day DATE, amount DECIMAL(10,2)"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_csv_edges(spark, folder):
    write(
        folder / "in" / "x_customers.csv",
        'id,name,day,amount\n1," a, b ",2024-01-02,5.00\n2,short\n3,bad,2024-13-40,1\n4,,2024-01-01,NULL\n,none,2024-01-01,1\n',
    )
    write(folder / "in" / "other.csv", "id,name,day,amount\n9,no,2024-01-01,1\n")
    got = files.load_csv(
        spark, str(folder / "in"), SCHEMA, glob="*customers*.csv", null_values=("NULL", "null", ""), required=["id"]
    )
    rows = {r.id: r for r in got.rows.collect()}
    assert set(rows) == {"1", "2", "4"}
    assert rows["1"].name.strip() == "a, b" and rows["2"].day is None and rows["4"].amount is None
    assert {r._reject_reason for r in got.rejects.collect()} == {"bad day", "missing id"}


def test_csv_by_name(spark, folder):
    write(folder / "in" / "a.csv", "AMOUNT,extra,Id\n7.5,x,1\n")
    row = files.load_csv(spark, str(folder / "in"), SCHEMA, by_name=True).rows.first()
    assert (row.id, float(row.amount), row.name) == ("1", 7.5, None)


def test_every_file_has_its_own_header(spark, folder):
    write(folder / "in" / "a.csv", 'id,name,amount\n1,"a, b",5.5\n2,c,x\n')
    write(folder / "in" / "b.csv", "Name, AMOUNT ,ID,more\nd,7,3,y\ne,8,4,z,beyond\n")
    write(folder / "in" / "empty.csv", "amount,id\n")
    got = files.load_csv(spark, str(folder / "in"), SCHEMA, by_name=True)
    assert {(r.id, r.name, float(r.amount)) for r in got.rows.collect()} == {("1", "a, b", 5.5), ("3", "d", 7.0)}
    assert {(r.id, r._reject_reason) for r in got.rejects.collect()} == {("2", "bad amount"), ("4", "too many fields")}


def test_lines_beyond_the_schema_are_rejected(spark, folder):
    write(folder / "in" / "a.csv", "id,name,day,amount\n1,a,2024-01-01,1,surplus\n2,b,2024-01-01,1\n3\n")
    got = files.load_csv(spark, str(folder / "in"), SCHEMA)
    assert {r.id for r in got.rows.collect()} == {"2", "3"}
    assert [(r.id, r._reject_reason) for r in got.rejects.collect()] == [("1", "too many fields")]


def test_odd_values(spark, folder):
    schema = "id STRING, at TIMESTAMP, note STRING"
    text = 'id,at,note\n1,2024-01-02T03:04:05Z,ok\n2,2024-01-02 03:04:05,"two, parts"\n3,never,x\n'
    write(folder / "in" / "a.csv", text)
    (folder / "in" / "b.csv").write_bytes(b"id,at,note\n4,2024-01-02T03:04:05Z,caf\xe9\n")
    got = files.load_csv(spark, str(folder / "in"), schema)
    rows = {r.id: r for r in got.rows.collect()}
    assert set(rows) == {"1", "2", "4"} and rows["2"].note == "two, parts"
    assert rows["1"].at == rows["4"].at and "caf" in rows["4"].note
    assert [r._reject_reason for r in got.rejects.collect()] == ["bad at"]


def test_loose_json(spark):
    df = spark.createDataFrame([("{'a': 1}",), ('{"a": 2}',), ("{oops",)], "x string")
    got = [r.v for r in df.select(F.try_variant_get(files.parse_loose_json("x"), "$.a", "int").alias("v")).collect()]
    assert got == [1, 2, None]


def test_xml_files_and_listing(spark, folder):
    doc = (
        '<n:Document xmlns:n="urn:x"><n:FIToFICstmrCdtTrf><n:GrpHdr><n:MsgId>M1</n:MsgId></n:GrpHdr><n:CdtTrfTxInf>'
        '<n:PmtId><n:EndToEndId>E1</n:EndToEndId></n:PmtId><n:IntrBkSttlmAmt Ccy="EUR">100000.00</n:IntrBkSttlmAmt>'
        "</n:CdtTrfTxInf></n:FIToFICstmrCdtTrf></n:Document>"
    )
    write(folder / "in" / "pacs008_1.xml", doc)
    write(folder / "in" / "sub" / "mortgage_1_internal.txt", "hello")
    row = ms.credit_transfers(xml.load_xml_text(spark, str(folder / "in"), "*.xml")).first()
    assert (row.message_id, row.end_to_end_id, row.transaction_currency) == ("M1", "E1", "EUR")
    assert row.is_high_value_payment and row.debtor_name is None and row.payment_corridor == "UNKNOWN -> UNKNOWN"
    found = files.list_files(spark, str(folder / "in"), "%mortgage%", "%_internal.txt").collect()
    assert [(r.relative_path, r.size) for r in found] == [("sub/mortgage_1_internal.txt", 5)]


BODY = "Id: STRING, Entry: ARRAY<STRUCT<Amt: STRUCT<_VALUE: STRING, _Ccy: STRING>, Note: STRING>>"


def loaded(spark, path, **options):
    out = xml.load_xml(spark, str(path), "Document", BODY, **options)
    rows = sorted((r.file_name, r.msg.Id, [e.Amt._VALUE if e.Amt else None for e in r.msg.Entry or []]) for r in out.rows.collect())
    return rows, sorted((r.file_name, r._reject_reason) for r in out.rejects.collect())


def test_several_documents_a_file(spark, folder):
    doc = "<Document{1}><Id>{0}</Id><Entry><Amt Ccy='CHF'>{0}.5</Amt></Entry><Entry><Note>a &lt;b&gt; \n c</Note></Entry></Document>".format
    head = '<?xml version="1.0"?>\r\n<!-- <Document>s follow -->\n'
    write(folder / "in" / "a.xml", head + doc(1, "") + "\n" + doc(2, ' xmlns="urn:x"') + "<!-- more -->" + doc(3, "") + "\n\n")
    write(folder / "in" / "b.xml", '<p:Document xmlns:p="urn:y"><p:Id>4</p:Id></p:Document>\n' + doc(5, "") + "<Document><Id>6</Id>")
    write(folder / "in" / "c.xml", doc(7, "").replace("</Note>", "") + doc(8, "") + "trailing")
    write(folder / "in" / "empty.xml", "")
    write(folder / "in" / "d.txt", doc(9, ""))
    rows, rejects = loaded(spark, folder / "in", glob="*.xml")
    assert rows == [("a.xml", str(i), [f"{i}.5", None]) for i in (1, 2, 3)] + [("b.xml", "4", []), ("b.xml", "5", ["5.5", None]), ("c.xml", "8", ["8.5", None])]
    assert rejects == [("b.xml", "no end of Document"), ("c.xml", "no end of Document"), ("c.xml", "not well formed")]


def test_one_large_file_is_read_by_many_tasks(spark, folder):
    docs = [f"<Document{' a=\"b\"' * (i % 2)}><Id>{i}</Id><Entry><Amt Ccy='CHF'>{i}</Amt></Entry></Document>\n" for i in range(500)]
    write(folder / "in" / "all.xml", "".join(docs))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        assert xml.xml_pieces(spark, str(folder / "in"), "Document").rdd.getNumPartitions() > 5
        rows, rejects = loaded(spark, folder / "in")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows == sorted(("all.xml", str(i), [str(i)]) for i in range(500)) and not rejects


def test_catalogue_has_first_lines(spark, folder):
    write(folder / "in" / "a.csv", "id,name\n" + "1,x\n" * 10)
    write(folder / "in" / "sub" / "b.csv", '"Name", ID')
    write(folder / "in" / "sub" / "none.csv", "")
    got = files.file_catalogue(spark, str(folder / "in"), "%.csv").collect()
    assert {(r.relative_path, r.size, r.header) for r in got} == {("a.csv", 48, "id,name"), ("sub/b.csv", 10, '"Name", ID')}
    assert files.file_catalogue(spark, str(folder / "in"), "sub/%", header=False).count() == 1
    assert files.header_names('"Name", ID ,"a, b"') == ("name", "id", "a, b")


def test_headers_need_no_scan_of_the_data(spark, folder):
    write(folder / "in" / "a.csv", "id,name,amount\n1,a,5\n")
    write(folder / "in" / "b.csv", "amount,id\n7,2\n")
    write(folder / "in" / "c.csv", "id,name,amount\n3,c,\n")
    rows = files.load_csv(spark, str(folder / "in"), SCHEMA, by_name=True).rows
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2 and "Join" not in plan and "FileScan text" not in plan
    assert sorted(r.id for r in rows.collect()) == ["1", "2", "3"]


def test_messages_are_tagged_once_and_read_by_kind(spark, folder):
    rows = [("pacs008_a.xml", "<x/>"), ("b.xml", "<FIToFIPmtStsRpt/>"), ("PACS002_c", "<FIToFICstmrCdtTrf/>"), ("d", "<y/>"), ("pacs008_e", None)]
    df = spark.createDataFrame(rows, "file_name string, raw_xml string").withColumn("load_ts", F.lit(None).cast("timestamp_ntz"))
    got = sinks.materialize(ms.tagged(df), str(folder / "m"), [ms.KIND])
    assert {(r.file_name, r.kind) for r in got.collect()} == {("pacs008_a.xml", "pacs008"), ("b.xml", "pacs002"), ("PACS002_c", "pacs002"), ("PACS002_c", "pacs008")}
    plan = ms.credit_transfers(got)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "kind" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert ms.credit_transfers(got).count() == ms.credit_transfers(df).count() == 2


def test_unanswered_transfer_is_kept(spark):
    a = '<Document><FIToFICstmrCdtTrf><GrpHdr><MsgId>{0}</MsgId></GrpHdr><CdtTrfTxInf><PmtId><EndToEndId>{0}</EndToEndId></PmtId></CdtTrfTxInf></FIToFICstmrCdtTrf></Document>'
    b = '<Document><FIToFIPmtStsRpt><OrgnlGrpInfAndSts><OrgnlMsgId>A</OrgnlMsgId></OrgnlGrpInfAndSts><TxInfAndSts><OrgnlEndToEndId>A</OrgnlEndToEndId><TxSts>RJCT</TxSts></TxInfAndSts></FIToFIPmtStsRpt></Document>'
    rows = [("pacs008_a", a.format("A")), ("pacs008_b", a.format("B")), ("pacs002_a", b)]
    df = spark.createDataFrame(rows, "file_name string, raw_xml string").withColumn("load_ts", F.lit(None).cast("timestamp_ntz"))
    got = ms.payment_lifecycle(ms.credit_transfers(df), ms.status_reports(df)).collect()
    assert {(r.pacs008_message_id, r.transaction_status_description) for r in got} == {("A", "REJECTED"), ("B", None)}


def test_insert_if_absent_and_snapshots(spark, folder):
    path = str(folder / "t")
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id int, v string")
    sinks.append_new(spark, path, df, ["id"])
    sinks.append_new(spark, path, df.union(spark.createDataFrame([(3, "c")], df.schema)), ["id"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    snap = str(folder / "s")
    for day, value in (("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-01", 3)):
        sinks.append_snapshot(spark.createDataFrame([(day, value)], "d string, v int"), snap, "d")
    assert {(str(r.d), r.v) for r in spark.read.parquet(snap).collect()} == {("2024-01-01", 3), ("2024-01-02", 2)}
    assert sinks.run_in_order(lambda: 1, lambda: 2) == [1, 2]


def test_stream_loads_each_file_once(spark, folder):
    source, sink, check, bad = (str(folder / x) for x in ("src", "sink", "check", "bad"))
    seen = []

    def run():
        ingest_stream(
            spark, source, SCHEMA, sink, check, glob="*.csv", rejects_dir=bad, refresh=lambda df, n: seen.append(df.count())
        ).awaitTermination()

    write(folder / "src" / "a.csv", "id,name,day,amount\n1,a,2024-01-01,1\n2,b,nope,1\n")
    run()
    run()
    write(folder / "src" / "b.csv", "id,name,day,amount\n3,c,2024-01-01,1\n")
    run()
    assert sorted(r.id for r in ingested(spark, sink).collect()) == ["1", "3"]
    assert seen == [1, 1] and spark.read.parquet(bad).count() == 1


def test_totals_follow_the_ingest(spark, folder):
    """Two batches, one of them replayed, and a batch after the totals were compacted equal the whole."""
    totals = refresh.Totals(
        keys={"k": F.lower("name")}, sums={"amount": "amount"}, counts={"n": True, "dear": F.col("amount") > 2}, least={"first": "day"}, greatest={"last": "day"}
    )
    path, moved = str(folder / "totals"), str(folder / "moved")
    source, sink, check = (str(folder / x) for x in ("src", "sink", "check"))

    def run(to):
        ingest_stream(spark, source, SCHEMA, sink, check, refresh=refresh.refresher({to: totals})).awaitTermination()

    def whole():
        return sorted(map(tuple, totals.of(ingested(spark, sink)).collect()))

    write(folder / "src" / "a.csv", "id,name,day,amount\n1,A,2024-01-01,1\n2,a,2024-02-01,5\n3,b,,\n")
    run(path)
    write(folder / "src" / "b.csv", "id,name,day,amount\n4,a,2023-01-01,2.5\n5,c,2024-01-01,9\n")
    run(path)
    for number in (0, 1):
        refresh.refresher({path: totals})(spark.read.parquet(f"{sink}/_batch={number}"), number)
    got = refresh.refreshed(spark, path, totals)
    assert sorted(map(tuple, got.collect())) == whole() and got.count() == 3
    refresh.compact(spark, path, totals, moved)
    assert sorted(map(tuple, refresh.refreshed(spark, moved, totals).collect())) == whole()
    write(folder / "src" / "c.csv", "id,name,day,amount\n6,c,2025-01-01,1\n")
    run(moved)
    assert sorted(map(tuple, refresh.refreshed(spark, moved, totals).collect())) == whole()


def test_messages_with_several_entries(spark):
    def entry(i):
        return f"<CdtTrfTxInf><PmtId><EndToEndId>E{i}</EndToEndId></PmtId><IntrBkSttlmAmt Ccy='CHF'>{i}.50</IntrBkSttlmAmt></CdtTrfTxInf>"

    head = "<Document><FIToFICstmrCdtTrf><GrpHdr><MsgId>M</MsgId><NbOfTxs>3</NbOfTxs></GrpHdr>"
    docs = [("pacs008_a.xml", head + "".join(map(entry, (1, 2, 3))) + "</FIToFICstmrCdtTrf></Document>"), ("pacs008_b.xml", head + "</FIToFICstmrCdtTrf></Document>")]
    df = spark.createDataFrame(docs, "file_name string, raw_xml string").withColumn("load_ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    got = ms.credit_transfers(df).select("source_filename", "transaction_index", "end_to_end_id", F.col("transaction_amount").cast("double")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [("pacs008_a.xml", i, f"E{i}", i + 0.5) for i in (1, 2, 3)] + [("pacs008_b.xml", None, None, None)], key=str
    )


def _transfer(body: str) -> str:
    return f"<Document><FIToFICstmrCdtTrf><GrpHdr><MsgId>M</MsgId></GrpHdr>{body}</FIToFICstmrCdtTrf></Document>"


PLAIN = {
    "schema order": "<CdtTrfTxInf><PmtId><TxId>T</TxId></PmtId><IntrBkSttlmAmt Ccy=\"EUR\">1.5</IntrBkSttlmAmt><Dbtr><Nm>D \u00e9 $1 \\2</Nm></Dbtr></CdtTrfTxInf>",
    "other order": "<CdtTrfTxInf><Cdtr><PstlAdr><Ctry>CH</Ctry></PstlAdr><Nm>C</Nm></Cdtr>\n <PmtId><TxId>T</TxId><InstrId>I</InstrId></PmtId></CdtTrfTxInf>",
    "other elements": "<X>1</X><CdtTrfTxInf><Purp><Cd>SALA</Cd></Purp><Dbtr><Nm>D</Nm><CtctDtls><Nm>no</Nm></CtctDtls></Dbtr></CdtTrfTxInf>",
    "two entries": "<CdtTrfTxInf><Dbtr><Nm>1</Nm></Dbtr></CdtTrfTxInf><CdtTrfTxInf><Dbtr><PstlAdr><Ctry>CH</Ctry></PstlAdr></Dbtr></CdtTrfTxInf>",
    "missing in the second": "<CdtTrfTxInf><ChrgBr>S</ChrgBr><PmtId><TxId>T</TxId></PmtId></CdtTrfTxInf><CdtTrfTxInf><PmtId><InstrId>I</InstrId></PmtId></CdtTrfTxInf>",
    "no entry": "",
}
OTHERS = {
    "repeated part": "<CdtTrfTxInf><Dbtr><Nm>1</Nm></Dbtr><ChrgBr>S</ChrgBr><Dbtr><PstlAdr><Ctry>CH</Ctry></PstlAdr></Dbtr></CdtTrfTxInf>",
    "reference": "<CdtTrfTxInf><Dbtr><Nm>a &amp; b</Nm></Dbtr></CdtTrfTxInf>",
    "empty and untrimmed": "<CdtTrfTxInf><ChrgBr/><Dbtr><Nm> </Nm></Dbtr><Cdtr><Nm> c </Nm></Cdtr></CdtTrfTxInf>",
    "in a comment": "<!-- <CdtTrfTxInf><ChrgBr>1</ChrgBr></CdtTrfTxInf> --><CdtTrfTxInf><ChrgBr>2</ChrgBr></CdtTrfTxInf>",
    "in another": "<X><CdtTrfTxInf><ChrgBr>1</ChrgBr></CdtTrfTxInf></X>",
    "between entries": "<CdtTrfTxInf><ChrgBr>1</ChrgBr></CdtTrfTxInf>&<CdtTrfTxInf><ChrgBr>2</ChrgBr></CdtTrfTxInf>",
    "other case": "<cdttrftxinf><chrgbr>1</chrgbr></cdttrftxinf>",
    "wrong end": "<CdtTrfTxInf><Purp><Cd>1</Xd></Purp><ChrgBr>1</ChrgBr></CdtTrfTxInf>",
    "separators": "\x02\x01a\x01\x04",
}


def test_plain_messages_need_no_parser(spark, monkeypatch):
    rows = [(k, _transfer(v)) for k, v in (PLAIN | OTHERS).items()] + [("marked", "\x03\x01a\x01\x02\x01b"), ("cut", _transfer("")[:-3])]
    df = spark.createDataFrame(rows, "file_name string, raw_xml string").withColumns(
        {"load_ts": F.lit(None).cast("timestamp_ntz"), ms.KIND: F.lit("pacs008")}
    )
    read = ms.Leaves(ms.StructType.fromDDL(ms.TRANSFER), ms.KINDS["pacs008"]).read(df, "raw_xml", "flat")
    assert {r.file_name for r in read.where("flat IS NOT NULL").collect()} == set(PLAIN)
    got = sorted(map(str, ms.credit_transfers(df).collect()))
    # the same from the parser alone
    monkeypatch.setattr(ms.Leaves, "read", lambda self, d, xml, out: d.withColumn(out, F.lit(None).cast("string")))
    assert got == sorted(map(str, ms.credit_transfers(df).collect())) and len(got) == len(rows) + 2


def test_tagging_makes_a_text_once(spark):
    made = spark.range(3).select(
        F.col("id").cast("string").alias("file_name"), F.concat(F.lit("<FIToFIPmtStsRpt/>MADE"), F.nullif("id", F.lit(1)).cast("string")).alias("raw_xml")
    )
    got = ms.tagged(made)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MADE") == 1
    assert sorted(r.file_name for r in got.collect()) == ["0", "2"]


def test_rows_and_rejects_come_from_one_reading(spark):
    """Packed files, read and parsed once; the columns of rows and rejects side by side."""
    from pathlib import Path

    from tidemark.plans.catalog import FOLDERS, MARTS, QUERIES
    from tidemark.plans.workspace import Workspace

    w = Workspace.of(spark, "/root/testdata/sf0.001", MARTS, FOLDERS)
    out = QUERIES["xml_load"](w)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") == 1 and "Union" not in plan
    files = [Path(x.removeprefix("file:")) for x in out.inputFiles()]
    assert files and all(x.name.endswith(".txt.gz") for x in files)
    assert out.where("reason IS NOT NULL AND entries IS NULL").count() > 0 and out.where("reason IS NULL AND entries > 1").count() > 0
