"""Log-shaped inputs that Spark derives from the given tables, row for row.

`events` becomes messages, CEF lines and odd values; `nation` and `region` become the
tools; `customer`, `supplier`, `pages` and `conversations` become rows, versions and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.sources.files import Rows, as_text
from logsieve.sources.spread import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, over all cores: what is made of them takes long to parse."""
    return spread(table(spark, sf_dir, "events"))


def _pick(selector: Column, *choices: Column) -> Column:
    """The choice whose position equals the selector."""
    picked = F.when(selector == 0, choices[0])
    for i, choice in enumerate(choices[1:], 1):
        picked = picked.when(selector == i, choice)
    return picked


def _host(number: Column) -> Column:
    return F.concat(F.lit("tool"), number.cast("string"), F.lit(".example.com"))


_LOG_ID = "CASE WHEN event_id % 11 = 5 THEN string(18446744073709551615BD - event_id) ELSE string(event_id) END"


def log_messages(spark: SparkSession, sf_dir: str, broken_every: int | None = None) -> DataFrame:
    """One JSON message per event. Destinations come in both cases and with outer spaces,
    every 7th message names none in `dstname`, every 14th of all names one in `url`
    instead. Numbers leave the range of narrow columns now and then; every 11th `logid` is close below
    2^64, every 13th `sentbyte` is 2^64. With `broken_every` each such message is cut short."""
    host = "concat('tool', user_id % 50, '.example.com')"
    fields = {
        "logid": _LOG_ID,
        "eventtime": r"""date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")""",
        "time": "CASE WHEN event_id % 10 = 3 THEN '12:34:56' END",
        "dstname": f"""CASE WHEN event_id % 7 = 0 THEN ''
            WHEN event_id % 2 = 0 THEN concat('  ', upper({host}), ' ') ELSE {host} END""",
        "url": """CASE WHEN event_id % 14 = 0 THEN concat('tool', user_id % 25, '.example.com')
            ELSE '' END""",
        "sessionid": "concat('s-', user_id)",
        "duration": "string(user_id * 3)",
        "srcip": "concat_ws('.', '10.0', string(user_id % 256), string(event_id % 300))",
        "srcport": "string(event_id * 7 % 70000)",
        "proto": "string(event_id % 300)",
        "action": "event_type",
        "app": "props",
        "sentbyte": "CASE WHEN event_id % 13 = 4 THEN '18446744073709551616' ELSE string(floor(value * 100)) END",
    }
    i = F.col("event_id")
    message = F.expr(
        "to_json(named_struct({}))".format(", ".join(f"'{k}', {v}" for k, v in fields.items()))
    )
    if broken_every:
        message = F.when(
            i % broken_every == 0, message.substr(F.lit(1), F.length(message) - 1)
        ).otherwise(message)
    return _events(spark, sf_dir).select("event_id", message.alias("value"))


def keyed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that name their destination under different keys, by event_id % 8."""
    i = F.col("event_id")
    host = _host(F.col("user_id"))
    pairs = _pick(
        i % 8,
        F.to_json(F.struct(host.alias("dstname"), F.lit("other").alias("url"))),
        F.to_json(F.struct(F.lit("").alias("dstname"), host.alias("url"), F.lit("x").alias("URL"))),
        F.to_json(F.struct(host.alias("URL"), F.lit("x").alias("tool_url"))),
        F.to_json(F.struct(host.alias("tool_url"), F.lit("x").alias("hostname"))),
        F.to_json(F.struct(F.upper(host).alias("hostname"))),
        F.to_json(F.struct(host.alias("dstName"))),
        F.to_json(F.struct(F.lit(" \t ").alias("dstname"), host.alias("url"))),
        F.concat(F.lit('{"dstname":null,"url":" '), host, F.lit('\\t"}')),
    )
    return _events(spark, sf_dir).select("event_id", pairs.alias("value"))


def tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tool per nation; its region decides how `has_ai` is written."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    flags = [F.lit("true"), F.lit(" YES "), F.lit("false"), F.lit("1")]
    return joined.select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit(" Tool"), F.col("n_nationkey").cast("string"), F.lit(".Example.COM")).alias("url"),
        _pick(F.col("n_regionkey"), *flags).alias("has_ai"),
        F.col("r_name").alias("ai_category"),
        (F.col("n_nationkey") / 10).alias("score"),
        F.lit(None).cast("string").alias("risk"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("updated_at"),
    )


def tools_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tools and, as later rows with the same urls, the suppliers of each nation;
    every tenth supplier has a blank url."""
    key = F.col("s_suppkey")
    later = table(spark, sf_dir, "supplier").select(
        (key + 1000).alias("id"),
        F.col("s_name").alias("name"),
        F.when(key % 10 == 0, "  ").otherwise(_host(F.col("s_nationkey"))).alias("url"),
        F.lit("true").alias("has_ai"),
        F.lit(None).cast("string").alias("ai_category"),
        F.col("s_acctbal").alias("score"),
        F.lit("low").alias("risk"),
        F.timestamp_micros((F.lit(1704153600) + key % 7 * 86400) * 1000000).alias("updated_at"),
    )
    return tools(spark, sf_dir).unionByName(later)


def tool_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions per supplier; which one is the latest depends on its number."""
    key = F.col("s_suppkey")
    version = F.explode(F.array(*[F.lit(v) for v in range(3)]))
    shift = (key + F.col("version")) % 3 * 86400 + key
    return (
        table(spark, sf_dir, "supplier")
        .withColumn("version", version)
        .select(
            key.alias("tool_id"),
            _host(key).alias("url"),
            F.concat_ws(" v", "s_name", F.col("version").cast("string")).alias("name"),
            (F.col("s_acctbal") + F.col("version")).alias("score"),
            F.timestamp_micros((F.lit(1704067200) + shift) * 1000000).alias("updated_at"),
        )
    )


def number_text() -> Column:
    """Numbers as logs write them, well and badly, by event_id % 8."""
    i, user = F.col("event_id"), F.col("user_id")
    whole = (i * 1000 + user).cast("string")
    return _pick(
        i % 8,
        whole,
        F.col("value").cast("string"),
        F.concat((user % 10).cast("string"), F.lit("e3")),
        F.concat(F.when(i % 16 == 3, "+").otherwise("-"), user.cast("string")),
        F.concat(F.lit("  "), whole, F.lit("\t")),
        F.lit(""),
        F.expr("""CASE event_id % 24 WHEN 6 THEN string(18446744073709551615BD - user_id)
            WHEN 14 THEN string(18446744073709551616BD + user_id) ELSE concat('99999999999999999999', user_id) END"""),
        F.col("event_type"),
    )


def ip_text() -> Column:
    i, user = F.col("event_id"), F.col("user_id")
    return _pick(
        i % 4,
        F.concat_ws(".", F.lit("10.0"), (user % 256).cast("string"), (i % 300).cast("string")),
        F.concat_ws(".", F.lit("192.168"), (user % 256).cast("string"), F.lit("1")),
        F.lit("::1"),
        F.lit(""),
    )


def time_text() -> Column:
    """The event's time in eight ways of writing, by event_id % 8."""
    day, clock = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    micros = F.date_format("ts", "SSSSSS")
    return _pick(
        F.col("event_id") % 8,
        F.concat(day, F.lit("T"), clock, F.lit("."), micros, F.lit("Z")),
        F.concat(day, F.lit("T"), clock, F.lit("-05:00")),
        day,
        seconds.cast("string"),
        F.concat(F.lit("junk "), clock),
        F.date_format("ts", "yyyyMMdd"),
        F.concat(day, F.lit(" "), clock, F.lit(" +0000 UTC")),
        F.concat(seconds.cast("string"), F.substring(micros, 1, 3)),
    )


def dirty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that hold the odd numbers, addresses and times above."""
    i = F.col("event_id")
    message = F.to_json(
        F.struct(
            F.expr(_LOG_ID).alias("logid"),
            time_text().alias("timestamp"),
            _host(F.col("user_id") % 25).alias("hostname"),
            ip_text().alias("dstip"),
            number_text().alias("sentbyte"),
            number_text().alias("dstport"),
        )
    )
    return _events(spark, sf_dir).select("event_id", message.alias("value"))


def cef_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CEF line per event. Every 5th vendor holds an escaped pipe, every 13th severity
    is a word, every 7th line repeats `src`; every 17th line lacks its header."""
    i, user = F.col("event_id"), F.col("user_id").cast("string")
    line = F.concat(
        F.when(i % 5 == 0, r"CEF:0|Ven\|dor|").otherwise("CEF:0|Ven|"),
        F.col("event_type"),
        F.lit("|1.0|"),
        i.cast("string"),
        F.lit("|user "),
        user,
        F.lit("|"),
        F.when(i % 13 == 0, "High").otherwise((i % 11).cast("string")),
        F.lit("|"),
        F.when(i % 7 == 0, "src=1.1.1.1 ").otherwise(""),
        F.lit("src=10.0.0."),
        (i % 256).cast("string"),
        F.lit(" dst=10.1.0."),
        user,
        F.lit(r" msg=a b\=c request=http://x/?a="),
        user,
        F.lit("&c=d "),
    )
    line = F.when(i % 17 == 0, F.concat(F.lit("bad "), line)).otherwise(line)
    return _events(spark, sf_dir).select("event_id", line.alias("value"))


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CEF line per web page, its whole source escaped into one extension."""
    html = F.col("html")
    for plain, escaped in (("\\", "\\\\"), ("=", "\\="), ("\n", "\\n"), ("\r", "\\r")):
        html = F.replace(html, F.lit(plain), F.lit(escaped))
    line = F.concat(F.lit("CEF:0|V|P|1|9|page|3|msg="), html, F.lit(" dst=10.0.0.1"))
    return table(spark, sf_dir, "pages").select("page_id", line.alias("value"))


def turn_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON message per conversation turn, with its whole text and a repeated key."""
    text = F.to_json(F.struct("role", "text"))
    doubled = F.concat(F.lit('{"role":"first",'), text.substr(F.lit(2), F.length(text)))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", doubled.alias("value"))


def customer_rows(spark: SparkSession, sf_dir: str) -> Rows:
    """Customers as text rows, every fifth without a segment."""
    df = table(spark, sf_dir, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.col("c_mktsegment"))
    )
    return Rows(df.select(*[as_text(df, c) for c in df.columns]), df.columns, df.columns)


def page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.col("page_id")
    ending = _pick(page % 5, *[F.lit(e) for e in (".LOG", ".cef", ".Csv", ".parquet", ".txt")])
    return table(spark, sf_dir, "pages").select(
        "page_id", F.concat(F.col("url"), F.lit("/f"), ending).alias("path")
    )
