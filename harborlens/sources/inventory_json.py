"""Cloud API responses stored as JSON documents, read with fixed schemas.

A fixed schema means no inference pass over the data, and a stable plan: the
JSON reader only materialises the fields named here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S = T.StringType()
TAGS = T.ArrayType(T.StructType([T.StructField("Key", _S), T.StructField("Value", _S)]))


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


INSTANCE = _struct(InstanceId=_S, State=_struct(Name=_S), InstanceType=_S,
                   Placement=_struct(AvailabilityZone=_S), Tags=TAGS)
SCHEMAS: dict[str, T.StructType] = {
    "ec2": _struct(Reservations=T.ArrayType(_struct(ReservationId=_S, Instances=T.ArrayType(INSTANCE)))),
    "ebs": _struct(Volumes=T.ArrayType(_struct(VolumeId=_S, State=_S, VolumeType=_S, Size=T.LongType(),
                                               AvailabilityZone=_S, Tags=TAGS))),
    "nat": _struct(NatGateways=T.ArrayType(_struct(NatGatewayId=_S, State=_S, SubnetId=_S, VpcId=_S,
                                                   NatGatewayAddresses=T.ArrayType(_struct(PublicIp=_S)), Tags=TAGS))),
    "elb": _struct(LoadBalancers=T.ArrayType(_struct(LoadBalancerName=_S, Type=_S, State=_struct(Code=_S),
                                                     Scheme=_S, DNSName=_S, VpcId=_S, Tags=TAGS))),
    "eks": _struct(clusters=T.ArrayType(_S)),
    "rds": _struct(DBInstances=T.ArrayType(_struct(DBInstanceIdentifier=_S, DBInstanceStatus=_S, DBInstanceClass=_S,
                                                   AllocatedStorage=T.LongType(), AvailabilityZone=_S, TagList=TAGS))),
    "endpoints": _struct(VpcEndpoints=T.ArrayType(_struct(VpcEndpointId=_S, ServiceName=_S, VpcEndpointType=_S, State=_S,
                                                          PrivateDnsEnabled=T.BooleanType()))),
}


REJECT = "_unreadable"


def read_pages(spark: SparkSession, path: str, kind: str, multiline: bool = True) -> DataFrame:
    """API documents of one kind, with ``_unreadable`` set to the text of those that are no valid JSON.

    ``multiline`` reads a response as a CLI prints it, indented over many lines
    (one document, or an array of documents, a file); without it each line is one
    response page, and large files are split between tasks."""
    schema = T.StructType([*SCHEMAS[kind].fields, T.StructField(REJECT, _S)])
    return (spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECT)
            .option("multiLine", str(multiline).lower()).json(path))


def read_inventory(spark: SparkSession, path: str, kind: str, multiline: bool = True, strict: bool = True) -> DataFrame:
    """The readable documents of one kind.

    ``strict`` (the default) makes the read fail on the first document that cannot
    be parsed: a lost page would hide resources.  Otherwise unreadable documents
    are left out here and returned by :func:`rejected_pages`."""
    if strict:
        return spark.read.schema(SCHEMAS[kind]).option("mode", "FAILFAST").option("multiLine", str(multiline).lower()).json(path)
    return read_pages(spark, path, kind, multiline).where(F.col(REJECT).isNull()).drop(REJECT)


def rejected_pages(spark: SparkSession, path: str, kind: str, multiline: bool = True) -> DataFrame:
    """(file, unreadable, partial): every document that cannot be parsed, the file it is in, and what could be read of it."""
    bad = read_pages(spark, path, kind, multiline).withColumn("file", F.input_file_name())
    partial = F.to_json(F.struct(*SCHEMAS[kind].fieldNames()))
    return bad.select("file", F.col(REJECT).alias("unreadable"), partial.alias("partial")).where(F.col("unreadable").isNotNull())


def write_inventory(pages: DataFrame, path: str) -> None:
    """Store API pages as JSON lines, one response page a line."""
    pages.drop("page").write.mode("overwrite").json(path)
