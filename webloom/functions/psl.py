"""Registered domains by the ICANN section of the Public Suffix List, as joins.

The list isn't kept here: it is read from the copy that PySpark's HTTP client jar carries, or from
any other file. Its rules number some thousands whatever the data's size, so they are broadcast.
Each distinct host is looked at once: its suffixes meet the rules, an exception rule wins, then the
longest rule; no rule, no registered domain.
"""

from __future__ import annotations

import datetime
import glob
import os
import re
import zipfile
from functools import lru_cache

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Suffixes reserved for local use.
RESERVED = ("local", "localhost", "internal", "test")
#: Other places of the list, tried in order.
PLACES = ("/usr/share/publicsuffix/public_suffix_list.dat",)
JAR_ENTRY = "mozilla/public-suffix-list.txt"
MOST_CHARS = 253


@lru_cache(maxsize=4)
def suffix_list(path: str | None = None) -> tuple[str, str]:
    """(text, where it is from and of which version or date) of the list.

    Tried in order: the path given, the one that PSL_PATH names, the copy in PySpark's jar, PLACES.
    A jar's copy is as old as the jar, so production sets a path.
    """
    path = path or os.environ.get("PSL_PATH")
    if path is None:
        for jar in sorted(glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "httpclient-*.jar"))):
            with zipfile.ZipFile(jar) as z:
                if JAR_ENTRY in z.namelist():
                    made = "-".join(f"{x:02d}" for x in z.getinfo(JAR_ENTRY).date_time[:3])
                    return z.read(JAR_ENTRY).decode(), f"{os.path.basename(jar)}, {made}"
        path = next((p for p in PLACES if os.path.isfile(p)), None)
    if path is None:
        raise FileNotFoundError("no public suffix list found; give its path")
    with open(path, encoding="utf-8") as file:
        text = file.read()
    version = re.search(r"^//\s*VERSION:\s*(\S+)", text, re.MULTILINE)
    return text, f"{path}, {version[1] if version else datetime.date.fromtimestamp(os.path.getmtime(path))}"


@lru_cache(maxsize=4)
def suffix_rules(path: str | None = None) -> tuple[tuple[str, str], ...]:
    """(suffix, kind) of the ICANN section; kind is exact, wildcard (suffix without *.) or exception (without !)."""
    text, _ = suffix_list(path)
    section = text.split("===BEGIN ICANN DOMAINS===")[-1].split("===END ICANN DOMAINS===")[0]
    rules = []
    for line in section.splitlines():
        rule = line.split("//")[0].strip().split(" ")[0]
        if rule:
            kind = "exception" if rule[0] == "!" else "wildcard" if rule.startswith("*.") else "exact"
            name = rule.lstrip("!").removeprefix("*.")
            rules.append((name if name.isascii() else name.encode("idna").decode(), kind))
    return tuple(rules)


def rules_frame(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The rules as rows (suffix, extra): extra is how many labels the public suffix has beyond its rule's.

    A wildcard adds a label to its suffix, an exception takes one off.
    """
    import pyarrow as pa

    extra = {"exact": 0, "wildcard": 1, "exception": -1}
    rules = suffix_rules(path)
    return spark.createDataFrame(pa.table({"suffix": [s for s, _ in rules], "extra": pa.array([extra[k] for _, k in rules], pa.int32())}))


def ascii_host(raw):
    """UDF column: a non-ASCII host by IDNA (UTS 46), null where that fails. Only such hosts reach it."""

    @F.pandas_udf("string")
    def encode(hosts):
        import pandas as pd

        def one(host):
            try:
                import idna

                return idna.encode(host, uts46=True).decode("ascii")
            except Exception:
                return None

        return pd.Series([one(h) for h in hosts], dtype=object)

    return encode(raw)


_IPV4 = r"^[0-9]{1,3}([.][0-9]{1,3}){3}$"


def clean_host(raw):
    """Trimmed, without dots at the ends, lower-case; null if empty, too long, an IP or with control characters."""
    host = F.lower(F.btrim(F.trim(raw), F.lit(".")))
    bad = (host == "") | (F.length(host) > MOST_CHARS) | host.rlike(r"[\x00-\x20\x7f]") | host.rlike(_IPV4) | host.contains(":") | host.contains("[")
    return F.when(~bad, host)


def registered_domains(hosts: DataFrame, path: str | None = None, unicode_hosts: bool = True) -> DataFrame:
    """(host, domain) for each distinct non-null host of hosts(host); domain is null where there is none."""
    spark = hosts.sparkSession
    distinct = hosts.select("host").where(F.col("host").isNotNull()).distinct().select("host", clean_host(F.col("host")).alias("name"))
    plain = F.col("name").rlike(r"^[\x21-\x7e]*$")
    if unicode_hosts:
        foreign = distinct.where(F.col("name").isNotNull() & ~plain).select("host", ascii_host(F.col("name")).alias("name"))
        distinct = distinct.where(F.col("name").isNull() | plain).unionByName(foreign)
    else:
        distinct = distinct.withColumn("name", F.when(plain, F.col("name")))
    labels = F.split("name", "[.]")
    tails = distinct.where(F.col("name").isNotNull()).select("host", labels.alias("labels"), F.explode(F.sequence(F.lit(1), F.size(labels))).alias("n"))
    tails = tails.select("host", "labels", "n", F.concat_ws(".", F.slice("labels", -F.col("n"), F.col("n"))).alias("suffix"))
    ruled = tails.join(F.broadcast(rules_frame(spark, path)), "suffix").where(F.size("labels") >= F.col("n") + F.greatest("extra", F.lit(0)))
    best = ruled.groupBy("host", "labels").agg(F.max(F.when(F.col("extra") < 0, F.col("n") - 1)).alias("exception"), F.max(F.when(F.col("extra") >= 0, F.col("n") + F.col("extra"))).alias("longest"))
    take = F.coalesce("exception", "longest") + 1
    empty_label = F.exists("labels", lambda x: (x == "") | (F.length(x) > 63))
    found = best.where((F.size("labels") >= take) & ~empty_label).select("host", F.concat_ws(".", F.slice("labels", -take, take)).alias("domain"))
    found = found.where(~F.element_at(F.split("domain", "[.]"), -1).isin(*RESERVED))
    return distinct.select("host").join(found, "host", "left")


def is_apex(host, domain):
    """Whether a host is its own registered domain, after cleaning."""
    return F.coalesce(clean_host(host) == domain, F.lit(False))
