"""Text, link and date functions against literal values."""

import pytest
from pyspark.sql import functions as F

from feedloom.functions import dates
from feedloom.functions.text import clean_text, title_key
from feedloom.functions.urls import with_url_key

URL_KEYS = {
    'HTTP://Ex.COM/a/b/?utm_source=x&b=2&a=1#f': 'http://ex.com/a/b?b=2&a=1',
    'http://x.com': 'http://x.com',
    'http://x.com/': 'http://x.com',
    'http://x.com//a//': 'http://x.com//a',
    'http:////a': 'http:////a',
    '//Host/p': '//host/p',
    '/rel/p/?q': '/rel/p?q=',
    'a;b;c?d=1': 'a?d=1',
    'http://h/p;x/y;z?k=%zz&v=%20a+b&~t=*': 'http://h/p;x/y?k=%25zz&v=+a+b&~t=%2A',
    'http://h/?flag&&x=1&=v': 'http://h?flag=&x=1&=v',
    'mailto:Foo@bar?x=1': 'mailto:Foo@bar?x=1',
    'http:/path': 'http:///path',
    'https:': 'https://',
    'http://h/中文?查=询&utm_x=1&UTM_y=2': 'http://h/中文?%E6%9F%A5=%E8%AF%A2&UTM_y=2',
    '  http://h/a b|c?d e=f': 'http://h/a b|c?d+e=f',
    'http://h/a?b=%20%zz&gclid=3': 'http://h/a?b=+%25zz',
    'ftp://H/p;type=a': 'ftp://h/p',
    'foo://H/p;type=a?x=y': 'foo://h/p;type=a?x=y',
    '1http://a/b': '1http://a/b',
    'http://h?x#y?z': 'http://h?x=',
    'h:80/p': 'h:80/p',
    'http://h/p?a=b=c&d': 'http://h/p?a=b%3Dc&d=',
    'svn+ssh://H/p/': 'svn+ssh://h/p',
    'http://h/a\tb\nc': 'http://h/abc',
    'x:/p/': 'x:/p',
    'x:p;q': 'x:p;q',
    'http://h/%7Euser?%75tm_source=1&a=%7E': 'http://h/%7Euser?a=~',
    '': '',
    '?a=1': '?a=1',
    '#f': '',
    'http://h/p?x=%F0%9F%98%80&y=é': 'http://h/p?x=%F0%9F%98%80&y=%C3%A9',
}


def test_url_keys(spark):
    rows = with_url_key(spark.createDataFrame([(u,) for u in URL_KEYS], "url string")).collect()
    assert {r.url: r.link_key for r in rows} == URL_KEYS


MOMENTS = {
    'Wed, 01 May 2024 10:00:00 GMT': '2024-05-01 10:00:00.000000',
    '1 May 24 10:00 EST': '2024-05-01 15:00:00.000000',
    'May 1, 2024 10:00:00 PDT': '2024-05-01 17:00:00.000000',
    'Wednesday, 01-May-24 10:00:00 GMT': '2024-05-01 10:00:00.000000',
    'Wed, 1 May 2024 10:00:00 +0530': '2024-05-01 04:30:00.000000',
    'Wed, 1 May 2024 25:00:00 +0530': None,
    '2024-05-01': '2024-05-01 00:00:00.000000',
    '2024-05-01T10:00:00Z': '2024-05-01 10:00:00.000000',
    '20260703T010203Z': '2026-07-03 01:02:03.000000',
    '2024-05-01T10': '2024-05-01 10:00:00.000000',
    '2024-05-01 10:00+02:00': '2024-05-01 08:00:00.000000',
    '2024': None,
    '2024-05': None,
    'junk': None,
    '': None,
    'Wed, 31 Feb 2024 10:00:00 GMT': None,
    '1 May 2024 10:00:60 GMT': None,
    '2024-05-01T10:00:00.123456+00:00': '2024-05-01 10:00:00.123456',
    '1 May 2024 10:00:00 -0000': '2024-05-01 10:00:00.000000',
    '1 May 2024 10:00:00 XYZ': '2024-05-01 10:00:00.000000',
    'Wed,01 May 2024 10:00:00 GMT': '2024-05-01 10:00:00.000000',
    '  Wed, 01 May 2024   10:00:00 GMT ': '2024-05-01 10:00:00.000000',
    '2024-13-01': None,
    '1 May 69 10:00:00 GMT': '1969-05-01 10:00:00.000000',
    '20240501': '2024-05-01 00:00:00.000000',
    '2024-05-01T10:00:00-0800': '2024-05-01 18:00:00.000000',
    '1 May 2024 10.30 GMT': '2024-05-01 10:30:00.000000',
    '5 September 2024 10:00 Z': '2024-09-05 10:00:00.000000',
    'Fri, 5 Sep 2024 10:00:00 -1130': '2024-09-05 21:30:00.000000',
}


def test_feed_dates(spark):
    rows = dates.with_feed_date(spark.createDataFrame([(v,) for v in MOMENTS], "v string"), "v", "p")
    found = {r.v: r.p for r in rows.select("v", F.date_format("p", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("p")).collect()}
    assert found == MOMENTS


def test_unreadable_record_date_stops_the_job(spark):
    good = spark.createDataFrame([("2024-05-01",), ("",), (None,)], "v string")
    assert [r.d is None for r in good.select(dates.record_date(F.col("v"), "date").alias("d")).collect()] == [False, True, True]
    bad = spark.createDataFrame([("yesterday",)], "v string")
    with pytest.raises(Exception, match="unreadable date"):
        bad.select(dates.record_date(F.col("v"), "date")).collect()


def test_iso_text_and_reference_time(spark):
    row = spark.createDataFrame([("2024-05-01",)], "d string").select(F.col("d").cast("date").alias("d"))
    end = row.select(dates.iso_text(dates.day_end(F.col("d"))).alias("t")).first().t
    assert end == "2024-05-01T23:59:59.999999+00:00"
    late = F.lit("2024-05-01 20:00:00").cast("timestamp")
    assert str(row.select(dates.local_day(late).alias("d")).first().d) == "2024-05-02"


CLEANED = {
    'a &amp; b': 'a & b',
    '&lt;p&gt;x&lt;/p&gt; y': 'x y',
    'x <b>y</b>\n z': 'x y z',
    ' a b\u3000c\x1fd ': 'a b c d',
    '&hellip;&#x41;&notanentity; & ;': '…A¬anentity; & ;',
    '': '',
    '1 < 2 > 3': '1 3',
    '&amp;lt;b&amp;gt;': '&lt;b&gt;',
    '&notit; &copy2024 &#150;&#x80; &#0; &#xD800; &#1114112; &eacute;l&eacute;ve &#1;&#11; &#x1F600; &ampamp; &acE; &fjlig;': '¬it; ©2024 –€ � � � éléve 😀 &amp; ∾̳ fj',
}


def test_clean_text(spark):
    frame = spark.createDataFrame([(t,) for t in [*CLEANED, None]], "t string")
    found = [r.c for r in frame.select(clean_text(F.col("t")).alias("c")).collect()]
    assert found == [*CLEANED.values(), ""]


def test_title_key(spark):
    frame = spark.createDataFrame([("AI—Agents: 2.0!  智能体 é",), ("Привет мир",)], "t string")
    assert [r.k for r in frame.select(title_key(F.col("t")).alias("k")).collect()] == ["ai agents 2 0 智能体", ""]


def test_title_key_at_the_edges_of_its_signs(spark):
    signs = "\x00/09:@`az{\x7f\u4dff\u4e00\u9fff\ua000\uffff\U0001f600\U0010ffff"
    frame = spark.createDataFrame([(sign,) for sign in signs], "t string")
    kept = [r.t for r in frame.select("t", title_key(F.col("t")).alias("k")).collect() if r.k == r.t]
    assert kept == list("09az\u4e00\u9fff")
