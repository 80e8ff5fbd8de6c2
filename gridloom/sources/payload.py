"""JSON payloads of the statistics API and the requests for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.text import url_to_path
from gridloom.operators.quarantine import check

# Where the records of a payload stand.
DATA_PATHS = ["$.BEAAPI.Data", "$.BEAAPI.Results.Data"]
PARAMETER_PATH = "$.BEAAPI.Results.ParamValue"
RECORDS = "array<map<string,string>>"

# Request of every data set, before and after its key.
BASE_URL = "https://apps.bea.gov/api/data/"
REQUESTS = {
    "ITA": (
        "&method=GetData&DataSetName=ITA&Indicator=",
        "&AreaOrCountry=ALL&Frequency=A,QSA,QNSA&Year=ALL&ResultFormat=json",
    ),
    "IIP": (
        "&method=GetData&DataSetName=IIP&TypeOfInvestment=",
        "&Component=ChgPos,ChgPosNie,ChgPosOth,ChgPosPrice,ChgPosTrans,ChgPosXRate,Pos&Frequency=A,QNSA&Year=ALL&ResultFormat=json",
    ),
    "IntlServTrade": (
        "&method=GetData&DataSetName=IntlServTrade&TypeOfService=",
        "&TradeDirection=ALL&Affiliation=ALL&AreaOrCountry=ALL&Year=ALL&ResultFormat=json",
    ),
    "IntlServSTA": (
        "&method=GetData&DataSetName=IntlServSTA&Channel=ALL&Destination=ALL&Industry=",
        "&AreaOrCountry=ALL&Year=ALL&ResultFormat=json",
    ),
}


def json_records(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per record: ``(…, record_idx, record map<string,string>)``."""
    parsed = [F.from_json(F.get_json_object(payload, p), RECORDS) for p in DATA_PATHS]
    rest = [c for c in payloads.columns if c != payload]
    return payloads.select(*rest, F.posexplode(F.coalesce(*parsed)).alias("record_idx", "record"))


def checked_payloads(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Payloads with the reason why none of their records can be read, for ``quarantine`` and ``good``."""
    text = F.col(payload)
    found = F.coalesce(*[F.get_json_object(text, p) for p in DATA_PATHS])
    parsed = F.coalesce(*[F.from_json(F.get_json_object(text, p), RECORDS) for p in DATA_PATHS])
    whole = F.get_json_object(text, "$").isNotNull()
    return check(payloads, {"not JSON": whole, "no data envelope": found.isNotNull(), "records are no list of objects": parsed.isNotNull()})


def record_fields(records: DataFrame, record: str = "record") -> list[str]:
    """Union of the record keys: the only thing that reaches the driver."""
    keys = records.select(F.explode(F.map_keys(record)).alias("k")).distinct()
    return sorted(r["k"] for r in keys.toLocalIterator())


def json_envelope(payloads: DataFrame, payload: str = "payload", fields: list[str] | None = None) -> DataFrame:
    """Records of both envelope forms as a table of text columns."""
    records = json_records(payloads, payload)
    fields = record_fields(records) if fields is None else fields
    rest = [c for c in records.columns if c != "record"]
    return records.select(*rest, *[F.col("record")[f].alias(f) for f in fields])


def json_param_values(payloads: DataFrame, payload: str = "payload", name: str = "Key") -> DataFrame:
    """Parameter values without their description, ``Key`` under a new name."""
    rest = [c for c in payloads.columns if c != payload]
    values = F.from_json(F.get_json_object(payload, PARAMETER_PATH), RECORDS)
    records = payloads.select(*rest, F.explode(values).alias("r"))
    return records.select(*rest, F.col("r")["Key"].alias(name))


def request_template(keys: DataFrame, dataset: Column, key: Column, shard: Column) -> DataFrame:
    """Request URLs of all data sets at once.

    ``shard`` names the credential to use, never the credential itself.
    """
    before, after = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, (head, tail) in REQUESTS.items():
        before = F.when(dataset == name, head).otherwise(before)
        after = F.when(dataset == name, tail).otherwise(after)
    relative = F.concat(F.lit("?&UserID="), shard, before, key, after)
    out = keys.withColumns({"base_url": F.lit(BASE_URL), "api_key": shard, "relative_url": relative})
    out = out.withColumn("full_url", F.concat("base_url", "relative_url"))
    return out.withColumn("blob_path", url_to_path(F.col("full_url")))
