"""Schemas and fixed values shared by all layers."""

from pyspark.sql import types as T

LOAD_DATE = "_load_date"

# --- fixed values: fields of the content log and of bronze ----------------------------------
RAW_CONTENT = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("_source", T.StructType([
        T.StructField("Contract", T.StringType()),
        T.StructField("Mac", T.StringType()),
        T.StructField("TotalDuration", T.LongType()),
        T.StructField("AppName", T.StringType()),
    ])),
])

BRONZE_CONTENT = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("contract", T.StringType()),
    T.StructField("mac", T.StringType()),
    T.StructField("total_duration", T.LongType()),
    T.StructField("app_name", T.StringType()),
    T.StructField(LOAD_DATE, T.StringType()),
])

# --- fixed values: content categories -------------------------------------------------------
# Column name in the silver tables -> short label used by most_watch and taste, in taste order.
CATEGORY_LABELS = {
    "Giải Trí": "Relax",
    "Phim Truyện": "Movie",
    "Thiếu Nhi": "Child",
    "Thể Thao": "Sport",
    "Truyền Hình": "TV",
}
OTHER_CATEGORY = "Khác"

# Application code -> category; every other code, and no code at all, is OTHER_CATEGORY.
APP_CATEGORIES = {
    "Truyền Hình": ["CHANNEL", "DSHD", "KPLUS", "KPlus"],
    "Phim Truyện": ["VOD", "FIMS", "FIMS_RES", "BHD", "BHD_RES", "VOD_RES", "DANET"],
    "Giải Trí": ["RELAX"],
    "Thiếu Nhi": ["CHILD"],
    "Thể Thao": ["SPORT"],
}

# Order in which the daily summary lists its category columns.
SUMMARY_CATEGORIES = ["Truyền Hình", "Phim Truyện", "Giải Trí", "Thiếu Nhi", "Thể Thao"]
STATS_CATEGORIES = [*SUMMARY_CATEGORIES, OTHER_CATEGORY]

CONTRACT_STATS = T.StructType(
    [T.StructField("contract", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in STATS_CATEGORIES]
    + [T.StructField("total_devices", T.LongType()), T.StructField(LOAD_DATE, T.StringType())]
)

# --- fixed values: keyword categories, first match wins -------------------------------------
KEYWORD_CATEGORIES = [
    ("TV", ["vtv", "htv", "thvl", "kênh", "truyền hình", "channel"]),
    ("Sport", [
        "vs ", "bóng đá", "bong da", "world cup", "ngoại hạng", "premier league", "gia lai",
        "chelsea", "arsenal", "sea games", "sport"]),
    ("Learning", ["tiếng anh", "tieng anh", "toán", "toan", "lớp ", "lop ", "learning"]),
    ("Cartoon", [
        "doraemon", "tom and jerry", "tom & jerry", "peppa", "paw patrol", "spongebob", "oggy",
        "mickey", "looney"]),
    ("Anime", [
        "conan", "naruto", "one piece", "dragon ball", "học viện anh hùng", "hoc vien anh hung",
        "demon slayer", "jujutsu", "boruto", "bleach", "chuyen sinh", "chuyển sinh", "sword art",
        "hunter x", "anime"]),
    ("CN Animation", [
        "tây hành", "tay hanh", "đấu la", "dau la", "đấu phá", "dau pha", "vạn giới",
        "tiên nghịch", "thần ấn"]),
    ("C-Drama", [
        "phàm nhân tu tiên", "thanh lạc", "vân tịch", "lộc đỉnh ký", "tam sinh", "cẩm tú",
        "trường an", "hoa thiên cốt", "thiên kim", "ngọc lau", "ngoc lau", "trinh sát", "pháp y",
        "hậu cung", "bật thầy", "ngọt ngào", "dữ quân", "du quan", "hoa mãn", "thiên long",
        "ỷ thiên", "thần điêu", "trần tình lệnh", "khánh dư niên", "lang điện hạ", "diên hy",
        "như ý", "chân hoàn", "trung quốc", "trung quoc", "hoa ngữ", "c-drama"]),
    ("K-Drama", [
        "hàn quốc", "han quoc", "kim tae", "song hye", "lee min ho", "hyun bin",
        "crash landing", "squid game", "itaewon", "penthouse", "kdrama", "k-drama", "goblin",
        "boys over", "hospital playlist", "vincenzo"]),
    ("Horror movie", [
        "kinh dị", "horror", "ma lai", "quỷ", "ma ám", "annabelle", "conjuring", "lời nguyền",
        "loi nguyen", "ám ảnh", "the nun", "insidious"]),
    ("Comedy", ["hài", "comedy", "tươi cười", "phấn khởi", "vui nhộn"]),
    ("Animation movie", [
        "hoạt hình", "animation", "pixar", "disney", "dreamworks", "chú vẹt", "chu vet",
        "minions", "frozen", "kung fu panda", "đuôi dài"]),
    ("Action movie", [
        "hành động", "hanh dong", "action", "vượt ngục", "vuot nguc", "fast furious", "avengers",
        "marvel", "john wick", "khủng long", "hoang dã", "jurassic", "thế giới khủng",
        "tiếng gọi"]),
    ("Romantic movie", [
        "yêu", "tình", "romantic", "love", "đích thực", "người yêu", "nguoi yeu", "siêu cấp",
        "định mệnh", "dinh menh", "vẻ đẹp", "ve dep", "high school king", "cô gái",
        "chàng trai"]),
]
UNMATCHED_KEYWORD = "Other"

# --- fixed values: data-quality limits (share of rows that may be rejected) -----------------
REJECTION_LIMITS = {"content": 0.05, "search": 0.40}
