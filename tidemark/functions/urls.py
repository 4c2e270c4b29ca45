"""Feed address to category and publisher."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category name and the address fragments that select it.  First hit wins.
CATEGORY_RULES = (
    ("Tin mới nhất", ("tin-moi-nhat", "trang-chu", "home")),
    ("Thời sự", ("thoi-su", "chinh-tri")),
    ("Giải trí", ("giai-tri",)),
    ("Kinh doanh", ("kinh-doanh", "kinh-te")),
    ("Thế giới", ("the-gioi",)),
    ("Thể thao", ("the-thao",)),
    ("Pháp luật", ("phap-luat",)),
    ("Giáo dục", ("giao-duc",)),
    ("Sức khỏe", ("suc-khoe",)),
    ("Đời sống", ("doi-song",)),
    ("Du lịch", ("du-lich",)),
    ("Khoa học", ("khoa-hoc",)),
    ("Công nghệ", ("so-hoa", "nhip-song-so", "cong-nghe", "khoa-hoc-cong-nghe")),
    ("Xe", ("xe", "oto-xe-may")),
    ("Giới trẻ", ("nhip-song-tre", "gioi-tre")),
    ("Văn hóa", ("van-hoa",)),
    ("Bất động sản", ("bat-dong-san", "dia-oc")),
    ("Cần biết", ("can-biet",)),
)
CATEGORY_OTHER = "Tổng hợp"

# Publisher name by domain.
PUBLISHERS = (
    ("VNExpress", "vnexpress.net"),
    ("Tuổi Trẻ", "tuoitre.vn"),
    ("VTC News", "vtcnews.vn"),
    ("Thanh Niên", "thanhnien.vn"),
)
PUBLISHER_OTHER = "Unknown"


def category(url: Column, rules=CATEGORY_RULES, other: str = CATEGORY_OTHER) -> Column:
    low = F.lower(url)
    cases = F
    for name, fragments in rules:
        hit = F.lit(False)
        for fragment in fragments:
            hit = hit | F.contains(low, F.lit(fragment))
        cases = cases.when(hit, F.lit(name))
    return cases.otherwise(F.lit(other))


def publisher(url: Column, rules=PUBLISHERS, other: str = PUBLISHER_OTHER) -> Column:
    low = F.lower(url)
    cases = F
    for name, domain in rules:
        cases = cases.when(F.contains(low, F.lit(domain)), F.lit(name))
    return cases.otherwise(F.lit(other))


def article_id(entry_id: Column, link: Column) -> Column:
    """Entry id, else the last address segment up to its first dot."""
    last = F.element_at(F.split(F.coalesce(link, F.lit("")), "/"), -1)
    return F.coalesce(F.nullif(entry_id, F.lit("")), F.split_part(last, F.lit("."), F.lit(1)))
