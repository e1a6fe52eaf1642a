"""Column functions for requests: validation, cookies, pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: names, texts and formats that appear in answers
COOKIE_NAME = "seen_banners_cookie"
COOKIE_DAYS = 30
COOKIE_TIME_FORMAT = "EEE, dd-MMM-yyyy HH:mm:ss 'PST'"
BAD_REQUEST_MESSAGE = "The request method is unsupported!"
NO_DATA_MESSAGE = "No Data found!"
COOKIE_TEXT = COOKIE_NAME + '=%s; domain=%s; expires=%s;"'
ERROR_PAGE = (
    "<html><head><title>400 Bad Request</title></head><body><h1>Bad Request</h1>"
    "<p>Your browser sent a request that this server could not understand.</p><p>%s</p></body></html>"
)

DEFAULT_DOMAIN = "banners.example.com"
DEFAULT_IMAGE_BASE = "https://banners.example.com/images"


def campaign_number(campaign_id: Column) -> Column:
    """The campaign id as an integer, NULL when it is not one."""
    return campaign_id.try_cast("int")


def request_status(method: Column, campaign_id: Column, has_data: bool = True) -> Column:
    """200, or 400 for a wrong method or id, or 500 when nothing was processed yet."""
    bad = (~method.eqNullSafe(F.lit("GET"))) | campaign_number(campaign_id).isNull()
    return F.when(bad, 400).otherwise(200 if has_data else 500)


def error_message(status: Column) -> Column:
    return F.when(status == 400, BAD_REQUEST_MESSAGE).when(status == 500, NO_DATA_MESSAGE)


def error_page(message: Column) -> Column:
    return F.format_string(ERROR_PAGE, message)


def seen_banners(cookie: Column) -> Column:
    """The integer list of the seen cookie; empty when absent or unreadable."""
    text = F.regexp_extract(cookie, rf"(?:^|;)\s*{COOKIE_NAME}\s*=\s*([^;=]*)", 1)
    ids = F.from_json(text, "array<int>")
    readable = ids.isNotNull() & ~F.exists(ids, lambda x: x.isNull())
    return F.when(readable, ids).otherwise(F.array().cast("array<int>"))


def id_list(ids: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(ids.cast("array<string>"), ", "), F.lit("]"))


def set_cookie(ids: Column, now: Column, domain: str = DEFAULT_DOMAIN) -> Column:
    """The cookie that remembers the served list for COOKIE_DAYS days."""
    expires = F.date_format(now + F.make_dt_interval(F.lit(COOKIE_DAYS)), COOKIE_TIME_FORMAT)
    return F.format_string(COOKIE_TEXT, id_list(ids), F.lit(domain), expires)


def page(ids: Column, image_base: str = DEFAULT_IMAGE_BASE) -> Column:
    """The HTML answer: one image per banner."""
    images = F.transform(
        ids, lambda b: F.concat(F.lit(f"<img src='{image_base}/image_"), b.cast("string"), F.lit(".png'>"))
    )
    return F.concat(F.lit("<html><body>"), F.array_join(images, ""), F.lit("</body></html>"))
