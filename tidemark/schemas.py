"""Schemas of the entities that the stages exchange."""

from pyspark.sql import types as T

_s, _l, _d = T.StringType(), T.LongType(), T.DoubleType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v, True) for k, v in fields.items()])


WATCH_EVENT = _struct(video_id=_s, title=_s, channel=_s, channel_url=_s, watched_at=_s, source=_s)
#: Watch events with their place in the input, which several results depend on.
ORDERED_EVENT = T.StructType([*WATCH_EVENT.fields, T.StructField("ingest_ord", _l, True)])
TAKEOUT_ENTRY = _struct(titleUrl=_s, header=_s, title=_s, subtitles=T.ArrayType(_struct(name=_s, url=_s)), time=_s)
CHANNEL_CACHE = _struct(video_id=_s, channel=_s, channel_url=_s)
CREATOR = _struct(channel=_s, channel_url=_s, videos=_l, events=_l, span_days=_l, first_watched=_s, last_watched=_s, sample_titles=T.ArrayType(_s))
RAW_VIDEO = _struct(id=_s, title=_s, upload_date=_s, duration=_d, view_count=_l, channel=_s, uploader=_s)
VIDEO = _struct(id=_s, title=_s, url=_s, upload_date=_s, duration=_d, view_count=_l)
CHANNEL = _struct(slug=_s, channel=_s, url=_s, tab=_s, video_count=_l)
INFO = _struct(id=_s, upload_date=_s, view_count=_l, duration=_d)
BROWSER_URL = _struct(url=_s, title=_s, visited=_l)
SRT_FILE = _struct(file=_s, size=_l, content=_s)
TRANSCRIPT = _struct(id=_s, body=_s)
DOC_RECORD = _struct(source=_s, file=_s, title=_s, author=_s, sha256=_s, extractor=_s, words=_l, status=_s, transcript=_s)
DOMAIN = T.StructType([T.StructField("ord", T.IntegerType()), T.StructField("domain", _s), T.StructField("pattern", _s)])
CLUSTER_MEMBER = _struct(id=_s, title=_s, views=_l, words=_l)
EXTRACTED = _struct(path=_s, extractor=_s, text=_s, error=_s)
