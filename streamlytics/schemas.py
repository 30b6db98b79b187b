"""Record schemas. Everything is declared; nothing is inferred."""

from pyspark.sql import types as T


LONG, INT, DOUBLE, TEXT = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
PLAIN_TIME = T.TimestampNTZType()
TEXT_MAP = T.MapType(TEXT, TEXT)


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


ADS_LOG = _schema(timestamp=LONG, area=TEXT, city=TEXT, userid=TEXT, adid=TEXT)
AREA_CITY_ADS = _schema(dt=TEXT, area=TEXT, city=TEXT, adid=TEXT, click_count=LONG)
AREA_TOP3 = _schema(dt=TEXT, area=TEXT, adid=TEXT, click_count=LONG, rank=INT)
SENSOR = _schema(id=TEXT, timestamp=LONG, temperature=DOUBLE)
PAY_INFO = _schema(userId=TEXT, productNum=LONG)
USER_BEHAVIOR = _schema(
    userId=LONG, itemId=LONG, categoryId=INT, behavior=TEXT, timestamp=LONG
)
ITEM_VIEW = _schema(itemId=LONG, windowEnd=LONG, count=LONG)
STUDENT = _schema(id=LONG, name=TEXT, age=INT)
USER_JSON = _schema(name=TEXT, age=TEXT, record_time=TEXT)
FLUME_EVENT = _schema(headers=TEXT_MAP, body=TEXT)
CHANGE_ENVELOPE = _schema(
    entry_type=TEXT, table=TEXT, event_type=TEXT, rows=T.ArrayType(TEXT_MAP)
)
OFFSETS = _schema(topic=TEXT, group=TEXT, partition=INT, offset=LONG)

# The given tables. Declared, so that reading one starts no job to look into its files.
TABLES = {
    "region": _schema(r_regionkey=INT, r_name=TEXT),
    "nation": _schema(n_nationkey=INT, n_name=TEXT, n_regionkey=INT),
    "customer": _schema(
        c_custkey=LONG, c_name=TEXT, c_nationkey=INT, c_acctbal=DOUBLE, c_mktsegment=TEXT
    ),
    "supplier": _schema(s_suppkey=LONG, s_name=TEXT, s_nationkey=INT, s_acctbal=DOUBLE),
    "part": _schema(
        p_partkey=LONG, p_name=TEXT, p_brand=TEXT, p_type=TEXT, p_size=INT,
        p_retailprice=DOUBLE
    ),
    "orders": _schema(
        o_orderkey=LONG, o_custkey=LONG, o_orderstatus=TEXT, o_totalprice=DOUBLE,
        o_orderdate=PLAIN_TIME, o_orderpriority=TEXT
    ),
    "lineitem": _schema(
        l_orderkey=LONG, l_partkey=LONG, l_suppkey=LONG, l_linenumber=INT, l_quantity=DOUBLE,
        l_extendedprice=DOUBLE, l_discount=DOUBLE, l_tax=DOUBLE, l_returnflag=TEXT,
        l_linestatus=TEXT, l_shipdate=PLAIN_TIME
    ),
    "events": _schema(
        event_id=LONG, ts=PLAIN_TIME, user_id=LONG, event_type=TEXT, value=DOUBLE, props=TEXT
    ),
    "documents": _schema(doc_id=LONG, text=TEXT, lang=TEXT, source=TEXT, n_chars=LONG),
    "pages": _schema(page_id=LONG, url=TEXT, html=TEXT),
    "conversations": _schema(conv_id=LONG, turn=LONG, role=TEXT, text=TEXT),
}
