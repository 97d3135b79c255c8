"""Link keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.settings import TRACKING_KEYS, TRACKING_PREFIX

_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"

# Schemes whose path may end in ";parameters", and schemes written with "//".
_SCHEMES_WITH_PARAMS = (
    "", "ftp", "hdl", "prospero", "http", "https", "imap", "mms", "rtsp", "rtsps", "rtspu", "sftp",
    "shttp", "sip", "sips", "tel",
)
_SCHEMES_WITH_HOST = (
    "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms", "https", "shttp",
    "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync", "svn", "svn+ssh", "sftp", "nfs", "git",
    "git+ssh", "ws", "wss", "itms-services",
)


def _decode(part: Column) -> Column:
    """Percent-decode; a stray percent sign stays as it is."""
    return F.url_decode(F.regexp_replace(part, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encode(part: Column) -> Column:
    """Percent-encode with ``~`` kept and ``*`` encoded."""
    return F.replace(F.replace(F.url_encode(part), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _pair_name(pair: Column) -> Column:
    return F.substring_index(pair, "=", 1)


def _is_tracking(name: Column) -> Column:
    return name.isin(*TRACKING_KEYS) | name.startswith(TRACKING_PREFIX)


def _clean_query(query: Column) -> Column:
    pairs = F.filter(
        F.split(query, "&"),
        lambda p: (p != "") & ~_is_tracking(_decode(_pair_name(p))),
    )
    encoded = F.transform(
        pairs,
        lambda p: F.concat(
            _encode(_decode(_pair_name(p))),
            F.lit("="),
            _encode(_decode(F.substr(p, F.length(_pair_name(p)) + 2))),
        ),
    )
    return F.array_join(encoded, "&")


def with_url_key(rows: DataFrame, url: str = "url", name: str = "link_key") -> DataFrame:
    """Add the key under which two links are the same.

    Scheme and host in lower case, no trailing slashes, parameters, fragment or tracking keys,
    other query pairs kept in order. Built in steps, so that each part is worked out once per row.
    """
    text, head, rest = F.col("_text"), F.col("_head"), F.col("_rest")
    scheme, host, path, query = F.col("_scheme"), F.col("_host"), F.col("_path"), F.col("_query")
    split = (
        rows.withColumn("_text", F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", ""))
        .withColumn("_text", F.substring_index("_text", "#", 1))
        .withColumn("_head", F.substring_index(text, "?", 1))
        .withColumns(
            {
                "_query": F.substr(text, F.length(head) + 2),
                "_scheme": F.lower(F.regexp_extract(head, f"^({_SCHEME}):", 1)),
                "_rest": F.regexp_replace(head, f"^{_SCHEME}:", ""),
            }
        )
        .withColumns(
            {
                "_host": F.lower(F.regexp_extract(rest, "^//([^/]*)", 1)),
                "_path": F.regexp_replace(rest, "^//[^/]*", ""),
            }
        )
        .withColumn("_path", F.when(scheme.isin(*_SCHEMES_WITH_PARAMS), F.regexp_replace(path, ";[^/]*$", "")).otherwise(path))
        .withColumns({"_path": F.regexp_replace(path, "/+$", ""), "_query": F.when(query != "", _clean_query(query)).otherwise("")})
    )
    slashes = (
        F.when((host != "") | path.startswith("//"), "//")
        .when(scheme.isin(*_SCHEMES_WITH_HOST) & ((path == "") | path.startswith("/")), "//")
        .otherwise("")
    )
    key = F.concat(
        scheme, F.when(scheme != "", ":").otherwise(""), slashes, host, path, F.when(query != "", "?").otherwise(""), query
    )
    return split.withColumn(name, key).drop("_text", "_head", "_rest", "_scheme", "_host", "_path", "_query")
