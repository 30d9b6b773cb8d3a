"""Interbank payment messages: credit transfers, status reports, and their life cycle."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.expr import c, choose, flag, minutes_crossed
from tidemark.functions.plain_xml import Leaves

_AGENT = "STRUCT<FinInstnId: STRUCT<BICFI: STRING>>"
_PARTY = "STRUCT<Nm: STRING, PstlAdr: STRUCT<StrtNm: STRING, PstCd: STRING, TwnNm: STRING, Ctry: STRING>>"
_ACCOUNT = "STRUCT<Id: STRUCT<IBAN: STRING>>"
_MONEY = "STRUCT<_VALUE: STRING, _Ccy: STRING>"
_CODE = "STRUCT<Cd: STRING>"
# element names of the two message types; order in the document does not matter
TRANSFER = f"""GrpHdr: STRUCT<MsgId: STRING, CreDtTm: STRING, NbOfTxs: STRING, TtlIntrBkSttlmAmt: {_MONEY},
  SttlmInf: STRUCT<SttlmMtd: STRING, ClrSys: {_CODE}>>,
  CdtTrfTxInf: ARRAY<STRUCT<PmtId: STRUCT<InstrId: STRING, EndToEndId: STRING, TxId: STRING>,
    PmtTpInf: STRUCT<InstrPrty: STRING, SvcLvl: {_CODE}, LclInstrm: {_CODE}>, IntrBkSttlmAmt: {_MONEY},
    IntrBkSttlmDt: STRING, ChrgBr: STRING, InstgAgt: {_AGENT}, InstdAgt: {_AGENT}, DbtrAgt: {_AGENT},
    CdtrAgt: {_AGENT}, Dbtr: {_PARTY}, DbtrAcct: {_ACCOUNT}, Cdtr: {_PARTY}, CdtrAcct: {_ACCOUNT},
    RmtInf: STRUCT<Ustrd: STRING>>>"""
STATUS = f"""GrpHdr: STRUCT<MsgId: STRING, CreDtTm: STRING, InstgAgt: {_AGENT}, InstdAgt: {_AGENT}>,
  OrgnlGrpInfAndSts: STRUCT<OrgnlMsgId: STRING, OrgnlMsgNmId: STRING, OrgnlCreDtTm: STRING, GrpSts: STRING>,
  TxInfAndSts: ARRAY<STRUCT<OrgnlEndToEndId: STRING, TxSts: STRING, StsRsnInf: STRUCT<Rsn: {_CODE}, AddtlInf: STRING>,
    OrgnlInstrId: STRING, OrgnlTxId: STRING, AccptncDtTm: STRING>>"""


def parse_xml(df: DataFrame, xml: str, body: str, root: str, out: str = "msg", where: Column | None = None) -> DataFrame:
    """Parse each document once into a struct, with or without its outer element; null outside ``where``."""
    schema = f"STRUCT<{root}: STRUCT<{body}>, {body}>"
    options = {"ignoreNamespace": "true", "mode": "PERMISSIVE"}
    parsed = F.from_xml(c(xml), schema, options)
    parsed = parsed if where is None else F.when(where, parsed)
    flat = [part.split(":")[0].strip() for part in _top_level(body)]
    inner = F.struct(*[F.coalesce(F.col(f"_p.{root}.{x}"), F.col(f"_p.{x}")).alias(x) for x in flat])
    # a one-element explode keeps the optimizer from repeating the parse for every field
    return df.withColumn("_p", F.explode(F.array(parsed))).withColumn(out, inner).drop("_p")


def _top_level(body: str) -> list[str]:
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(body):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            parts.append(body[start:i])
            start = i + 1
    return [*parts, body[start:]]


KIND = "kind"
KINDS = {"pacs008": "FIToFICstmrCdtTrf", "pacs002": "FIToFIPmtStsRpt"}


def tagged(messages: DataFrame) -> DataFrame:
    """Messages with their kind, told by file name or outer element; a message of several kinds comes once for each.

    Stored by kind, later readers open only the documents of theirs. Messages of no known kind are left out.
    """
    # a filter on the text would go below its making, and make it once more
    there = F.col("raw_xml").isNotNull()
    kinds = [F.when(there & (F.col("file_name").ilike(f"%{mark}%") | F.col("raw_xml").contains(root)), F.lit(mark)) for mark, root in KINDS.items()]
    return messages.withColumn(KIND, F.explode(F.array_compact(F.array(*kinds))))


def _of_kind(messages: DataFrame, mark: str) -> DataFrame:
    return (messages if KIND in messages.columns else tagged(messages)).where(F.col(KIND) == mark)


def _entries(messages: DataFrame, body: str, root: str) -> tuple[DataFrame, Callable[[str], Column], Callable[[str], Column]]:
    """One row per entry of the list, numbered from 1, and its columns by path: of the message (h) and of the entry (t).

    A message without entries keeps one row. Plain documents are read by expressions, all others by the XML parser.
    """
    fields = StructType.fromDDL(body)
    leaves = Leaves(fields, root)
    df = leaves.read(messages, "raw_xml", "_flat")
    df = parse_xml(df, "raw_xml", body, root, where=F.col("_flat").isNull())
    df = df.withColumns({"xml_size_bytes": F.length("raw_xml"), "_head": leaves.head("_flat"), "_texts": leaves.listed("_flat")})
    items = f"msg.{leaves.items.name}"
    texts = F.coalesce("_texts", F.array_repeat(F.lit(None).cast("string"), F.size(items)))
    df = df.withColumn("_texts", texts).drop("raw_xml", "_flat").select("*", F.posexplode_outer("_texts").alias("_at", "_text"))
    df = df.drop("_texts").withColumns({"transaction_index": F.col("_at") + 1, "_item": leaves.item("_text")})
    other = F.get(items, F.col("_at"))

    def h(path: str) -> Column:
        return F.coalesce(leaves.leaf("_head", leaves.of_head[path]), F.col(f"msg.{path}"))

    def t(path: str) -> Column:
        return F.coalesce(leaves.leaf("_item", leaves.of_item[path]), reduce(Column.getField, path.split("."), other))

    return df, h, t


def _time(x) -> Column:
    return c(x).try_cast("timestamp_ntz")


def credit_transfers(messages: DataFrame) -> DataFrame:
    """Every transfer of every credit-transfer message as one typed row."""
    df, head, t = _entries(_of_kind(messages, "pacs008"), TRANSFER, KINDS["pacs008"])

    def h(path: str) -> Column:
        return head(f"GrpHdr.{path}")

    def party(side: str, name: str) -> list[Column]:
        where = {"street": "StrtNm", "postal_code": "PstCd", "city": "TwnNm", "country": "Ctry"}
        return [
            t(f"{side}.Nm").alias(f"{name}_name"),
            *[t(f"{side}.PstlAdr.{tag}").alias(f"{name}_{x}") for x, tag in where.items()],
            t(f"{side}Acct.Id.IBAN").alias(f"{name}_iban"),
        ]

    amount = t("IntrBkSttlmAmt._VALUE").try_cast("decimal(28,2)")
    origin, target = t("Dbtr.PstlAdr.Ctry"), t("Cdtr.PstlAdr.Ctry")
    clearing = h("SttlmInf.ClrSys.Cd")
    return df.select(
        F.col("file_name").alias("source_filename"),
        F.col("load_ts").alias("source_load_timestamp"),
        h("MsgId").alias("message_id"),
        _time(h("CreDtTm")).alias("creation_datetime"),
        h("NbOfTxs").try_cast("int").alias("number_of_transactions"),
        "transaction_index",
        h("TtlIntrBkSttlmAmt._Ccy").alias("group_settlement_currency"),
        h("TtlIntrBkSttlmAmt._VALUE").try_cast("decimal(28,2)").alias("group_settlement_amount"),
        h("SttlmInf.SttlmMtd").alias("settlement_method"),
        clearing.alias("clearing_system_code"),
        t("PmtId.InstrId").alias("instruction_id"),
        t("PmtId.EndToEndId").alias("end_to_end_id"),
        t("PmtId.TxId").alias("transaction_id"),
        t("PmtTpInf.InstrPrty").alias("instruction_priority"),
        t("PmtTpInf.SvcLvl.Cd").alias("service_level_code"),
        t("PmtTpInf.LclInstrm.Cd").alias("local_instrument_code"),
        t("IntrBkSttlmAmt._Ccy").alias("transaction_currency"),
        amount.alias("transaction_amount"),
        t("IntrBkSttlmDt").try_cast("date").alias("interbank_settlement_date"),
        t("ChrgBr").alias("charges_bearer"),
        *[
            t(f"{tag}.FinInstnId.BICFI").alias(f"{name}_agent_bic")
            for tag, name in (("InstgAgt", "instructing"), ("InstdAgt", "instructed"), ("DbtrAgt", "debtor"), ("CdtrAgt", "creditor"))
        ],
        *party("Dbtr", "debtor"),
        *party("Cdtr", "creditor"),
        t("RmtInf.Ustrd").alias("remittance_information"),
        flag(amount >= 100000).alias("is_high_value_payment"),
        flag(clearing == "TARGET2").alias("is_target2_payment"),
        F.concat(F.coalesce(origin, F.lit("UNKNOWN")), F.lit(" -> "), F.coalesce(target, F.lit("UNKNOWN"))).alias(
            "payment_corridor"
        ),
        F.when(origin == target, "DOMESTIC").otherwise("CROSS_BORDER").alias("payment_type_classification"),
        "xml_size_bytes",
    )


GROUP_STATUS = {"ACCP": "ACCEPTED", "RJCT": "REJECTED", "PDNG": "PENDING"}
TX_STATUS = {**GROUP_STATUS, "ACSC": "ACCEPTED_SETTLEMENT_COMPLETED", "ACSP": "ACCEPTED_SETTLEMENT_IN_PROCESS"}


def status_reports(messages: DataFrame) -> DataFrame:
    """Every transaction status of every status report as one typed row."""
    df, head, t = _entries(_of_kind(messages, "pacs002"), STATUS, KINDS["pacs002"])

    def h(path: str) -> Column:
        return head(f"GrpHdr.{path}")

    def o(path: str) -> Column:
        return head(f"OrgnlGrpInfAndSts.{path}")

    tx, group, original = t("TxSts"), o("GrpSts"), o("OrgnlMsgId")
    return df.select(
        F.col("file_name").alias("source_filename"),
        F.col("load_ts").alias("source_load_timestamp"),
        h("MsgId").alias("message_id"),
        _time(h("CreDtTm")).alias("creation_datetime"),
        h("InstgAgt.FinInstnId.BICFI").alias("instructing_agent_bic"),
        h("InstdAgt.FinInstnId.BICFI").alias("instructed_agent_bic"),
        original.alias("original_message_id"),
        o("OrgnlMsgNmId").alias("original_message_name_id"),
        _time(o("OrgnlCreDtTm")).alias("original_creation_datetime"),
        group.alias("group_status"),
        "transaction_index",
        t("OrgnlEndToEndId").alias("original_end_to_end_id"),
        tx.alias("transaction_status"),
        F.coalesce(t("StsRsnInf.Rsn.Cd"), t("StsRsnInf.AddtlInf")).alias("status_reason"),
        t("OrgnlInstrId").alias("original_instruction_id"),
        t("OrgnlTxId").alias("original_transaction_id"),
        _time(t("AccptncDtTm")).alias("acceptance_datetime"),
        choose(tx, TX_STATUS, tx).alias("transaction_status_description"),
        choose(group, GROUP_STATUS, group).alias("group_status_description"),
        flag(tx.isin("ACCP", "ACSC", "ACSP")).alias("is_positive_response"),
        flag(tx == "RJCT").alias("is_rejection"),
        flag(o("OrgnlMsgNmId") == "pacs.008.001.08").alias("is_pacs008_response"),
        F.when(original.like("20%-%-%"), F.substring(original, 1, 8)).alias("original_message_date"),
        "xml_size_bytes",
    )


def payment_lifecycle(transfers: DataFrame, reports: DataFrame) -> DataFrame:
    """Each transfer with the statuses that answer it: a hash join on the message id."""
    r = reports.select(
        "original_message_id", "original_end_to_end_id", "original_transaction_id", "transaction_status",
        "transaction_status_description", "group_status", "group_status_description", "status_reason", "is_rejection",
        "is_positive_response", F.col("source_filename").alias("pacs002_file"),
        F.col("source_load_timestamp").alias("pacs002_load_timestamp"),
        minutes_crossed("original_creation_datetime", "creation_datetime").alias("ack_time"),
    )
    answers = (r["original_end_to_end_id"] == transfers["end_to_end_id"]) | (
        r["original_transaction_id"] == transfers["transaction_id"]
    )
    return transfers.join(r, (r["original_message_id"] == transfers["message_id"]) & answers, "left").select(
        F.col("message_id").alias("pacs008_message_id"),
        F.col("original_message_id").alias("pacs002_original_message_id"),
        F.col("end_to_end_id").alias("pacs008_end_to_end_id"),
        F.col("original_end_to_end_id").alias("pacs002_original_end_to_end_id"),
        "transaction_status", "transaction_status_description", "group_status", "group_status_description",
        "status_reason", "is_rejection", "is_positive_response", "transaction_currency", "transaction_amount",
        "debtor_name", "creditor_name", "payment_corridor", "payment_type_classification", "is_high_value_payment",
        "is_target2_payment",
        F.col("source_filename").alias("pacs008_file"),
        "pacs002_file",
        F.col("source_load_timestamp").alias("pacs008_load_timestamp"),
        "pacs002_load_timestamp",
        "ack_time",
    )
