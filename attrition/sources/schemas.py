"""Input and output contracts (only the columns the operators touch)."""

from pyspark.sql import types as T

DIMENSIONS = T.ArrayType(T.StructType([
    T.StructField("index", T.IntegerType()),
    T.StructField("value", T.StringType()),
]))

ATTRIBUTION_EVENTS = T.StructType([
    T.StructField("advertising_id", T.StringType()),
    T.StructField("appsflyer_id", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("event_time_sm", T.DateType()),
    T.StructField("atribuicao_canais", T.StringType()),
    T.StructField("media_source", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("bandeira_partition", T.StringType()),
    T.StructField("device", T.StringType()),
])

HIT = T.StructType([
    T.StructField("HitNumber", T.IntegerType()),
    T.StructField("time", T.LongType()),
    T.StructField("hour", T.StringType()),
    T.StructField("minute", T.StringType()),
    T.StructField("customDimensions", DIMENSIONS),
    T.StructField("eventInfo", T.StructType([
        T.StructField("eventCategory", T.StringType()),
        T.StructField("eventAction", T.StringType()),
        T.StructField("eventLabel", T.StringType()),
    ])),
])

HITS = T.StructType([
    T.StructField("FullVisitorId", T.StringType()),
    T.StructField("visitId", T.LongType()),
    T.StructField("visitNumber", T.IntegerType()),
    T.StructField("date", T.IntegerType()),
    T.StructField("channelGrouping", T.StringType()),
    T.StructField("device", T.StructType([T.StructField("operatingSystem", T.StringType())])),
    T.StructField("geoNetwork", T.StructType([T.StructField("region", T.StringType())])),
    T.StructField("trafficSource", T.StructType([T.StructField("isTrueDirect", T.BooleanType())])),
    T.StructField("totals", T.StructType([
        T.StructField("hits", T.IntegerType()),
        T.StructField("screenviews", T.IntegerType()),
        T.StructField("UniqueScreenviews", T.IntegerType()),
        T.StructField("sessionQualityDim", T.IntegerType()),
    ])),
    T.StructField("customDimensions", DIMENSIONS),
    T.StructField("hits", HIT),
    T.StructField("OrigemParticao", T.StringType()),
    T.StructField("AaParticao", T.StringType()),
    T.StructField("MmParticao", T.StringType()),
    T.StructField("BandeiraParticao", T.StringType()),
])

CUSTOMERS = T.StructType([
    T.StructField("origem", T.StringType()),
    T.StructField("bandeira", T.StringType()),
    T.StructField("idcliente", T.StringType()),
    T.StructField("sexo", T.StringType()),
    T.StructField("datanascimento", T.DateType()),
])

PREDICTION = T.StructType([
    T.StructField("id_ga", T.StringType()),
    T.StructField("prob_uninstall", T.DoubleType()),
    T.StructField("DtRef", T.StringType()),
    T.StructField("TsAtualizacao", T.TimestampType()),
    T.StructField("AaParticao", T.StringType()),
    T.StructField("MmParticao", T.StringType()),
    T.StructField("DdParticao", T.StringType()),
])

PARTITION_COLUMNS = ("AaParticao", "MmParticao", "DdParticao")


def missing_columns(df, schema: T.StructType) -> list[str]:
    have = {c.lower() for c in df.columns}
    return [f.name for f in schema.fields if f.name.lower() not in have]
