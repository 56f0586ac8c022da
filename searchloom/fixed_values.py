"""Results are only right if these are exactly as given here."""

# Path endings that make a link not worth crawling.
EXCLUDED_EXTENSIONS = (
    "css", "js", "mid", "mp2", "mp3", "mp4", "wav", "avi", "mov", "mpeg", "ram",
    "m4v", "rm", "smil", "wmv", "swf", "wma", "zip", "rar", "gz", "json", "ttf",
    "svg", "ico", "xml",
)

# Where result links sit in a stored result page, best first.
RESULT_SELECTORS = (
    "div.result__body a.result__a",
    "div.results a.result__a",
    "div.links_main a.result__a",
    "div.results_links a.large",
    "article.result h2 a",
    "div.result__title a",
)

# The redirect links of a result page.
REDIRECT_HOST = "duckduckgo.com"
REDIRECT_PATH = "/l/"
REDIRECT_PARAMETER = "uddg="

# Phrases indexed by default.
TARGET_PHRASES = (
    "computer science", "information retrieval", "power politics",
    "los angeles", "bruce willis",
)

# Content types that get a visit row without being parsed.
BINARY_CONTENT_TYPES = ("application/pdf", "image/jpeg", "image/png", "image/gif")

# Upper edges (bytes, exclusive) and names of the size buckets.
SIZE_BUCKETS = (
    (1024, "< 1KB"),
    (10240, "1KB ~ <10KB"),
    (102400, "10KB ~ <100KB"),
    (1048576, "100KB ~ <1MB"),
    (None, ">= 1MB"),
)

# Headers of the text files.
FETCH_LOG_HEADER = ("URL", "Status")
VISIT_LOG_HEADER = ("URL", "Size", "OutLinks", "ContentType")
URL_LOG_HEADER = ("URL", "Valid")
RANKING_STATS_HEADER = (
    "Query", "Number of Overlapping Results", "Percent Overlap", "Spearman Coefficient",
)
AVERAGES_LABEL = "Averages"
FAILED_STATUS = "FAILED"
VALID_LABEL, INVALID_LABEL = "OK", "N_OK"

# Section titles and line names of the crawl report.
REPORT_SECTIONS = (
    "Fetch Statistics", "Outgoing URLs:", "Status Codes:", "File Sizes:", "Content Types:",
)
REPORT_HEAD = ("News site crawled", "Number of threads")
FETCH_LINES = ("# fetches attempted", "# fetches succeeded", "# fetches failed or aborted")
URL_LINES = (
    "Total URLs extracted",
    "# unique URLs extracted",
    "# unique URLs within News Site",
    "# unique URLs outside News Site",
)

# Limits.
RESULTS_PER_QUERY = 10
MAX_PAGES = 20000
MAX_DEPTH = 16
INDEX_PART_FILES = 5
NEAREST_LIMIT = 20

# URL schemes as the standard URL library groups them.
SCHEMES_WITH_RELATIVE_LINKS = (
    "", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp",
    "mms", "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss",
)
SCHEMES_WITH_PARAMS = (
    "", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp", "rtsps",
    "rtspu", "sip", "sips", "mms", "sftp", "tel",
)
