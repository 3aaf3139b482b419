"""Record schemas, label codings and the default parameters of every operator."""

from pyspark.sql import types as T

# Field names, sentinels, codings and defaults that results depend on.
REQUIRED_FIELDS = ["id", "author", "created_utc", "body", "score", "subreddit", "controversiality"]
DELETED_MARKERS = ["[deleted]", "[removed]"]
LABELS = ["negative", "neutral", "positive"]
LABEL_CLASS = {"negative": 0, "neutral": 1, "positive": 2}
LABEL_SIGN = {"negative": -1, "neutral": 0, "positive": 1}
UNKNOWN_LABEL = "unknown"
NO_MATCH = -1.0
OPEN_BOUND = -1
STREAM_MIN_UTC, STREAM_MAX_UTC, STREAM_MIN_BODY = -1, -1, 10
ARCHIVE_MIN_UTC, ARCHIVE_MAX_UTC, ARCHIVE_MIN_BODY = 1554076800, 1555472130, 5
WINDOW_COMMENTS = 3000
RETRAIN_ROWS = 50_000
STATE_BATCHES = 100
RELOAD_SECONDS = 3000
HEARTBEAT_SECONDS = 5
CHECKPOINT_SECONDS = 30
REPLAY_SPEED = 1.0
CHUNK_ROWS = 1_000_000
THRESHOLDS = [0.05, 0.1, 0.2, 0.3]
LABEL_THRESHOLD = 0.1
FREQUENT_SUBREDDIT = 100
SERIES_POINTS = 100
TRAIN_CHUNKS, TEST_CHUNKS = [3, 34, 55], [13, 28, 60]


def _struct(text: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (f.split(":") for f in text.split())])


_TYPES = {"s": T.StringType(), "l": T.LongType(), "i": T.IntegerType(), "d": T.DoubleType()}

RAW_COMMENT = _struct("id:s author:s created_utc:l body:s score:l subreddit:s controversiality:i")
CLEANED_COMMENT = _struct("id:s created_utc:l subreddit:s score:l body:s cleaned_body:s original_length:i")
LABELED_COMMENT = _struct("id:s created_utc:l subreddit:s score:l cleaned_body:s label:s original_length:i")
ARCHIVE_LABELED = _struct("id:s created_utc:l subreddit:s body:s label:s score:l controversiality:i")
META_CHUNK = _struct("id:s created_utc:l subreddit:s score:l controversiality:i label:s")
KEYWORD_REQUEST = _struct("user_id:s keyword1:s keyword2:s request_time:s")
KEYWORD_RESPONSE = _struct(
    "user_id:s keyword1:s value1:d total1:l keyword2:s value2:d total2:l timestamp:s"
)
SESSION_EVENT = _struct("seq:l user_id:s action:s keyword1:s keyword2:s event_utc:l")
