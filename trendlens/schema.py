"""Schemas and fixed values of the observation data model."""

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------
# They decide results, so they must not drift.

CATEGORY_NAMES = {
    1: "Film & Animation",
    2: "Autos & Vehicles",
    10: "Music",
    15: "Pets & Animals",
    17: "Sports",
    19: "Travel & Events",
    20: "Gaming",
    22: "People & Blogs",
    23: "Comedy",
    24: "Entertainment",
    25: "News & Politics",
    26: "Howto & Style",
    27: "Education",
    28: "Science & Technology",
}
UNKNOWN_CATEGORY = "Unknown"

ISO_REGEX = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"

NO_DESCRIPTION = "No description"
NO_TAGS = "[none]"

# Monday first: the order of every weekday report.
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")

UNUSED_COLUMNS = (
    "thumbnail_link",
    "comments_disabled",
    "video_error_or_removed",
    "ratings_disabled",
)

COUNTERS = ("view_count", "likes", "dislikes", "comment_count")

# Model input, in vector order, and the label.
FEATURES = (
    "categoryId",
    "engagement_rate",
    "like_rate",
    "comment_rate",
    "like_comment_ratio",
    "view_scale",
    "engagement_scale",
    "publish_hour",
    "day_of_week",
    "is_weekend",
    "is_prime_time",
)
LABEL = "growth_potential"

# Columns of the correlation matrix, in report order.
CORRELATED = (
    "view_count_num",
    "likes_num",
    "dislikes_num",
    "comment_count_num",
    "total_engagement",
    "like_rate",
    "comment_rate",
    "engagement_rate",
)

# Values a stored prediction falls back to.
DEFAULT_TITLE = "Unknown"
DEFAULT_CATEGORY = 24

# --- schemas ----------------------------------------------------------------------


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# Raw files are read as text only: inferring types would make the parsing of dates
# depend on how dirty the file happens to be.
RAW_SCHEMA = T.StructType(
    _strings(
        "video_id",
        "title",
        "publishedAt",
        "channelId",
        "channelTitle",
        "categoryId",
        "trending_date",
        "tags",
        "view_count",
        "likes",
        "dislikes",
        "comment_count",
        "thumbnail_link",
        "comments_disabled",
        "ratings_disabled",
        "description",
    )
)

# The layout of older raw files has one column more; cleaning drops it.
OLD_RAW_SCHEMA = T.StructType(
    RAW_SCHEMA.fields[:-1] + _strings("video_error_or_removed") + RAW_SCHEMA.fields[-1:]
)

# A stream message is one raw observation plus the time it was published. All
# fields are text here too: an int field would turn "10" into NULL.
MESSAGE_SCHEMA = T.StructType(RAW_SCHEMA.fields + _strings("kafka_timestamp"))

LISTING_SCHEMA = T.StructType(
    [
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.StringType()),
                        T.StructField(
                            "snippet",
                            T.StructType(
                                _strings(
                                    "title",
                                    "publishedAt",
                                    "channelId",
                                    "channelTitle",
                                    "categoryId",
                                )
                                + [
                                    T.StructField("tags", T.ArrayType(T.StringType())),
                                    T.StructField(
                                        "thumbnails",
                                        T.StructType(
                                            [
                                                T.StructField(
                                                    "default",
                                                    T.StructType(_strings("url")),
                                                )
                                            ]
                                        ),
                                    ),
                                ]
                                + _strings("description")
                            ),
                        ),
                        T.StructField(
                            "statistics",
                            T.StructType(
                                _strings("viewCount", "likeCount", "commentCount")
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)
