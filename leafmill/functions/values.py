"""Patterns, word lists, tables and formats that results depend on. All are used as they stand here."""

# --- limits -------------------------------------------------------------
ATTRIBUTES = 1000          # longest run of attributes a tag pattern follows
STRAY_TAIL = 512           # shortest tail without '>' in which '<' is made harmless
TITLE_CHARS, FEED_TITLE_CHARS, FEED_SUMMARY_CHARS, META_CHARS, BYLINE_CHARS, BYLINE_HEAD = 80, 120, 200, 80, 40, 600
JSON_STRING_CHARS, JSON_DEPTH = 1500, 12
OVERLAP_MIN, OVERLAP_MAX = 30, 300
NEXT_TEXT_CHARS, NEXT_SCANS = 16, 400
BINARY_HEAD, CONTROL_SHARE = 512, 0.3
RETRY_CAP_MS = 5000
CACHE_TTL_S, FAILURE_TTL_S = 300, 30
MARKDOWN_DEPTH = 100

# --- white space as trim() of the web knows it ---------------------------
SPACE = r"\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF"

# --- entities: name -> character -----------------------------------------
ENTITIES = {
    "nbsp": " ", "ensp": " ", "emsp": " ", "thinsp": " ", "zwnj": "", "zwj": "",
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'",
    "ndash": "–", "mdash": "—", "hellip": "…", "middot": "·", "bull": "•",
    "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”",
    "laquo": "«", "raquo": "»", "copy": "©", "reg": "®", "trade": "™",
    "deg": "°", "plusmn": "±", "times": "×", "divide": "÷", "micro": "µ",
    "sect": "§", "para": "¶", "dagger": "†", "prime": "′",
    "permil": "‰", "euro": "€", "pound": "£", "yen": "¥", "cent": "¢",
    "sup2": "²", "sup3": "³", "frac12": "½", "frac14": "¼", "frac34": "¾",
}
ENTITY = "^(?:#[0-9]+|#x[0-9a-f]+|[a-z][a-z0-9]{1,7});?"

# --- tags -----------------------------------------------------------------
RAW_TAGS = ("textarea", "style", "script", "noscript", "template")
BOX_TAGS = ("nav", "footer", "header", "aside", "form", "iframe", "svg", "canvas", "dialog")
TEXT_TAGS = ("script", "style", "textarea", "noscript")
NOISE_CLASSES = ("ad-", "ads", "advert", "banner", "sidebar", "social", "share", "comment", "popup", "modal", "cookie")
BLOCK_TAGS = ("p", "div", "section", "article", "main", "h[1-6]", "table", "tbody", "tr", "ul", "ol", "li", "blockquote", "pre", "dl", "figure", "figcaption", "fieldset")

# --- density ---------------------------------------------------------------
SEGMENT_MIN, SEGMENT_SHORT, LINK_SHARE, ARTICLE_MIN = 2, 300, 0.65, 200

# --- metadata ----------------------------------------------------------------
PUBLISHED = ("article:published_time", "og:published_time", "pubdate", "publishdate", "date", "dc.date")
AUTHOR = ("author", "article:author", "og:article:author")
DESCRIPTION = ("og:description", "description")
BYLINE_AUTHOR = "(?:作者|責任編輯|責任主编|editor)[：:\\s]{1,3}([^\\s，,。/|()（）\\[\\]]{2,24})"
BYLINE_DATE = "(?:发表日期|发布日期|发表时间|发布时间|日期|发表于|发布于|published(?:\\s+on)?)[：:\\s]{0,3}(\\d{4}[-/.年]\\s?\\d{1,2}[-/.月]\\s?\\d{1,2}日?|\\d{4}-\\d{2}-\\d{2}(?:[T ]\\d{2}:\\d{2})?)"

# --- gates --------------------------------------------------------------------
CONTENT_TYPES = "text/html|application/xhtml|text/plain|/json|[+/]xml"
CHALLENGE = "just a moment|performing security verification|verifying (you are|your) human|cf-chl|cf_chl|cdn-cgi/challenge-platform|attention required!\\s*[|·]?\\s*cloudflare|enable javascript and cookies to continue"
SPA_SCRIPTS = 5
NOISE_FILES = "\\.(png|jpe?g|gif|svg|webp|ico|bmp|css|js|json|xml|pdf|zip|gz|tar|7z|mp3|mp4|avi|mov|webm|woff2?|ttf|eot|map)(\\?|#|$)"
NOISE_PATHS = "(/login|/signin|/register|/logout|/signup|/api/|/admin|/wp-admin|/wp-login|/feed|/rss|/sitemap|/robots\\.txt|/cdn-cgi)"

# --- what may stand between a tag's name and its end: up to a thousand quoted strings and other characters ---
TAG_REST = r"""(?:"[^"]*"|'[^']*'|[^'">]){0,1000}"""

# --- sentences ----------------------------------------------------------------------
SENTENCE = "[^.!?\n。！？]+[.!?\n。！？]*"

# --- navigation ------------------------------------------------------------------
NEXT_TEXT = "^(?:[›»>]+\\s*)?(?:下一页|下页|下一篇|下一頁|下頁|后一页|後一頁|next page|next|older entries|[›»>]{1,3})(?:\\s*[›»>]+)?$"

# --- hints in text forms ------------------------------------------------------------
HINT_END = "(offset 已到文末，无更多内容)"
HINT_EMPTY = "登录墙 / SPA 页 / 空页面；SPA 需安装 playwright"
NOTHING = "(无可读内容)"
HINT_BLOCKED, HINT_BLOCKED_EMPTY = "已渲染但被人机验证页拦截，保留静态提取结果", "已渲染但被人机验证页拦截（无静态内容可用）"
HINT_RENDERED_EMPTY = "已渲染仍无可读内容（可能登录墙或反爬拦截）"
SITEMAP = "Unsupported content (XML sitemap)"
BATCH_LINKS, CRAWL_LINKS, CRAWL_QUEUE = 6, 100, 20  # links shown, links taken of a page, queue places for each page of the budget

# --- charset labels of the web's encoding standard, by codec ---------------------------------
_LABELS = {
    "utf-8": "unicode-1-1-utf-8 utf-8 utf8 x-unicode20utf8",
    "utf-16-le": "utf-16 utf-16le ucs-2 unicode iso-10646-ucs-2 csunicode",
    "utf-16-be": "utf-16be",
    "cp866": "866 cp866 csibm866 ibm866",
    "iso8859_2": "csisolatin2 iso-8859-2 iso-ir-101 iso8859-2 iso88592 l2 latin2",
    "iso8859_3": "csisolatin3 iso-8859-3 iso-ir-109 iso8859-3 iso88593 l3 latin3",
    "iso8859_4": "csisolatin4 iso-8859-4 iso-ir-110 iso8859-4 iso88594 l4 latin4",
    "iso8859_5": "csisolatincyrillic cyrillic iso-8859-5 iso-ir-144 iso8859-5 iso88595",
    "iso8859_6": "arabic asmo-708 csisolatinarabic ecma-114 iso-8859-6 iso-ir-127 iso8859-6 iso88596",
    "iso8859_7": "csisolatingreek ecma-118 elot_928 greek greek8 iso-8859-7 iso-ir-126 iso8859-7 iso88597",
    "iso8859_8": "csisolatinhebrew hebrew iso-8859-8 iso-8859-8-e iso-8859-8-i iso-ir-138 iso8859-8 iso88598 logical visual",
    "iso8859_10": "csisolatin6 iso-8859-10 iso-ir-157 iso8859-10 iso885910 l6 latin6",
    "iso8859_13": "iso-8859-13 iso8859-13 iso885913",
    "iso8859_14": "iso-8859-14 iso8859-14 iso885914",
    "iso8859_15": "csisolatin9 iso-8859-15 iso8859-15 iso885915 l9",
    "iso8859_16": "iso-8859-16",
    "koi8_r": "cskoi8r koi koi8 koi8-r koi8_r",
    "koi8_u": "koi8-ru koi8-u",
    "mac_roman": "csmacintosh mac macintosh x-mac-roman",
    "mac_cyrillic": "x-mac-cyrillic x-mac-ukrainian",
    "cp874": "dos-874 iso-8859-11 iso8859-11 iso885911 tis-620 windows-874",
    "cp1250": "cp1250 windows-1250 x-cp1250",
    "cp1251": "cp1251 windows-1251 x-cp1251",
    "cp1252": "ansi_x3.4-1968 ascii cp1252 cp819 csisolatin1 ibm819 iso-8859-1 iso-ir-100 iso8859-1 iso88591 l1 latin1 us-ascii windows-1252 x-cp1252",
    "cp1253": "cp1253 windows-1253 x-cp1253",
    "cp1254": "cp1254 csisolatin5 iso-8859-9 iso-ir-148 iso8859-9 iso88599 l5 latin5 windows-1254 x-cp1254",
    "cp1255": "cp1255 windows-1255 x-cp1255",
    "cp1256": "cp1256 windows-1256 x-cp1256",
    "cp1257": "cp1257 windows-1257 x-cp1257",
    "cp1258": "cp1258 windows-1258 x-cp1258",
    "gb18030": "chinese csgb2312 csiso58gb231280 gb18030 gb2312 gb_2312 gbk iso-ir-58 x-gbk",
    "big5hkscs": "big5 big5-hkscs cn-big5 csbig5 x-x-big5",
    "euc_jp": "cseucpkdfmtjapanese euc-jp x-euc-jp",
    "iso2022_jp": "csiso2022jp iso-2022-jp",
    "cp932": "csshiftjis ms932 ms_kanji shift-jis shift_jis sjis windows-31j x-sjis",
    "cp949": "cseuckr csksc56011987 euc-kr iso-ir-149 korean ks_c_5601-1987 ksc5601 ksc_5601 windows-949",
}
CHARSETS = {label: codec for codec, labels in _LABELS.items() for label in labels.split()}
CODE_PAGES = frozenset(c for c in _LABELS if c.startswith("cp125") or c == "cp874")
