"""The logical registrations schema every operator reads."""

from pyspark.sql import types as T

REGISTRATIONS = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("row_id", T.LongType()),
    T.StructField("order_ts", T.TimestampNTZType()),
    T.StructField("attendee_status", T.StringType()),
    T.StructField("ticket_type", T.StringType()),
    T.StructField("total_paid", T.DecimalType(18, 2)),
    T.StructField("role", T.StringType()),
    T.StructField("experience", T.StringType()),
    T.StructField("session_goals", T.StringType()),
    T.StructField("speaker_q", T.StringType()),
    T.StructField("future_topics", T.StringType()),
])

REG_COLUMNS = [f.name for f in REGISTRATIONS.fields]

# Whether the event's export has a column for a key at all.
HAS_COLUMNS = [f"has_{k}" for k in ("order_date", "attendee_status", "ticket_type", "total_paid", "role", "experience",
                                    "session_goals", "speaker_q", "future_topics")]

# Free-text / choice answer columns in long form (answers table).
ANSWER_KEYS = ["attendee_status", "ticket_type", "role", "experience",
               "session_goals", "speaker_q", "future_topics"]

THEME = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("count", T.IntegerType()),
    T.StructField("quotes", T.ArrayType(T.StringType())),
])

THEME_FILE = T.StructType([
    T.StructField("speaker_question_clusters", T.ArrayType(THEME)),
    T.StructField("future_topic_clusters", T.ArrayType(THEME)),
    T.StructField("non_specific_speaker_count", T.IntegerType()),
    T.StructField("non_specific_topics_count", T.IntegerType()),
    T.StructField("timeline_insight", T.StringType()),
    T.StructField("role_insight", T.StringType()),
])
