"""The label sets and codes the reports must agree on."""

# Delivery vendor by raw code.
CDN_BY_CODE = {
    "bd": "百度",
    "baidu": "百度",
    "qn": "七牛",
    "tx": "腾讯",
    "al": "阿里",
    "ali": "阿里",
    "ws": "网宿",
    "yf": "云帆",
    "js": "金山",
}
CDN_OTHER = "未定义"

# Report order of the vendors.
CDN_ORDER = ("网宿", "百度", "腾讯", "阿里", "七牛", "云帆", "金山", "未定义")

# Client name by platform code.
DEVICE_BY_PLATFORM = {1: "Android", 2: "iOS", 5: "PC", 9: "H5", 14: "PC新秀"}
DEVICE_OTHER = "其他"

# Platform codes of the three report classes.
PLATFORM_CLASSES = {"pc": (5, 14), "android": (1,), "ios": (2,)}

# Carriers.
ISP_EDU = "教育网"
ISP_BIG_THREE = ("电信", "移动", "联通")
ISP_BIG_THREE_CLASS = "三大运营商"
ISP_OTHER = "其他"
ISP_REPORT_ORDER = ("电信", "移动", "联通", "教育网")
ISP_CLASS_ORDER = ("三大运营商", "教育网", "其他")

# Carrier names searched inside the raw name, first hit wins.
ISP_SEARCH_ORDER = ("鹏博士", "教育网", "铁通", "电信", "移动", "联通")

# Latency bucket bounds in milliseconds.
LATENCY_FAST_MS = 1000
LATENCY_SLOW_MS = 3000
LATENCY_RANGES = (1, 2, 3)

# Invalid room, event kinds.
NO_ROOM = -1
TAG_STALL = "monitor"
TAG_FIRST = "first"
TAG_CONNECT = "connect"
