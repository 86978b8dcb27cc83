"""Word lists, patterns and formats that decide results.

Everything in this module is data, kept together and in its natural order, because the results of
the library depend on the exact values.
"""

# Stop words of the keyword extractors (TF-IDF and graph ranking).
KEYWORD_STOP_WORDS = (
    "the", "of", "is", "and", "to", "in", "that", "we", "for", "an", "are",
    "by", "be", "as", "on", "with", "can", "if", "from", "which", "you", "it",
    "this", "then", "at", "have", "all", "not", "one", "has", "or", "that",
)

# Stop words of the search analyzer.
ANALYZER_STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "can",
    "for", "from", "have", "if", "in", "is", "it", "may",
    "not", "of", "on", "or", "tbd", "that", "the", "this",
    "to", "us", "we", "when", "will", "with", "yet",
    "you", "your", "的", "了", "和",
)

# Parts of speech that graph ranking keeps by default.
RANK_POS = ("ns", "n", "vn", "v")

# Tokens that end a sentence.
SENTENCE_ENDS = (".", "!", "?", "\n", "。", "！", "？")

# First and last character of the range treated as Chinese.
CJK_FIRST = "一"
CJK_LAST = "鿕"

# What an undecodable value becomes.
INVALID_TEXT = "invalid"

# News sites: the (attribute, value) of the body container, and the pattern of one link in the
# site's roll page.
SITES = ("ZXW", "163", "RMW", "SINA", "IFENG")

BODY_CONTAINER = {
    "ZXW": ("class", "left_zw"),
    "163": ("id", "endText"),
    "RMW": ("id", "p_content"),
    "SINA": ("id", "artibody"),
    "IFENG": ("id", "main_content"),
}

LINK_PATTERN = {
    "ZXW": r'<div class="dd_bt"><a href=[^<>]*>[^<>]*</a></div>'
           r'<div class="dd_time">[\d]{1,2}-[\d]{1,2} [\d]{2}:[\d]{2}</div>',
    "RMW": r"<a href[^<>]*>[^<>]*</a>\[[\d]{2}[^<>]*[\d]{2}:[\d]{2}\]<br>",
    "163": r't"[^}]*',
    "SINA": r",title[^}]*",
    "IFENG": r"<h4>[\d]{2}/[\d]{2} [\d]{2}:[\d]{2}</h4><a href=[^<>]*>[^<]*",
}

# Roll page address per site; {y}, {m}, {d} are the zero-padded date parts, {page} the page number.
ROLL_PAGE_URL = {
    "ZXW": "http://www.chinanews.com/scroll-news/{y}/{m}{d}/news.shtml",
    "163": "http://snapshot.news.163.com/wgethtml/"
           "http+!!news.163.com!special!0001220O!news_json.js/{y}-{m}/{d}/0.js",
    "RMW": "http://people.com.cn/GB/24hour/index{y}_{m}_{d}.html",
    "SINA": "http://roll.news.sina.com.cn/interface/rollnews_ch_out_interface.php"
            "?col=89&spec=&type=&date={y}-{m}-{d}"
            "&k=&offset_page=0&offset_num=0&num=30000&asc=&page=1",
    "IFENG": "http://news.ifeng.com/rt-channel/rtlist_{y}{m}{d}/{page}.shtml",
}

# Sites read when the caller names none.
DEFAULT_SITES = ("ZXW",)

# Prefix of relative links.
LINK_BASE = {"ZXW": "http://www.chinanews.com"}

# Mark of a paginated article and of a roll page without entries.
ALL_PAGES_MARK = "_all.html#p1"
EMPTY_ROLL_PAGE_PATTERN = r'div class="mat"[^>]*'

# Named character references that stand for text; any other is dropped.
NAMED_REFERENCES = {"lt": "<", "gt": ">", "amp": "&", "quot": '"', "apos": "'"}

# Manifest layout.
MANIFEST_SEPARATOR = "###"
MANIFEST_HEADER_LEFT = "===========NEWS_LIST"
MANIFEST_HEADER_RIGHT = "============"

# Damping and number of rounds of graph ranking, and the co-occurrence span.
RANK_DAMPING = 0.85
RANK_ROUNDS = 10
RANK_SPAN = 5

# Porter stemmer: suffix -> replacement. Steps 2 and 3 apply when the stem has measure > 0, step 4
# when it has measure > 1.
PORTER_STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("logi", "log"),
)
PORTER_STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
    ("ness", ""),
)
PORTER_STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)
