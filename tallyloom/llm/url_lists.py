"""Globs over host and path by which pages of little text are told, built from short lists."""

from __future__ import annotations

from tallyloom.llm.url_rules import Rule, glob, word_rule

#: Words of hosts that carry little but advertising, malware or copied media.
BLOCKED_WORDS = (
    "spam", "casino", "cheap-pills", "pharmacy", "viagra", "porn", "xxx", "escort", "lottery",
    "betting", "poker", "payday", "warez", "torrent", "keygen", "adserver", "doubleclick",
    "tracker", "phish", "malware", "clickbait", "free-money", "replica-watch",
)
#: Labels of hosts that serve parts of pages, not pages.
PART_LABELS = (
    "ad", "ads", "analytics", "api", "banner", "beacon", "cdn", "click", "counter", "img", "metrics",
    "pixel", "static", "stats", "telemetry", "thumbs", "track",
)
#: Steps of paths that lead to forms, lists and machinery.
FORM_STEPS = (
    "account", "admin", "ads", "basket", "calendar", "captcha", "cart", "cgi-bin", "checkout", "comment-page",
    "cookies", "feed", "login", "logout", "password-reset", "print", "register", "rss", "search", "share",
    "signin", "signup", "subscribe", "tagcloud", "trackback", "unsubscribe", "wishlist", "wp-admin", "wp-json",
    "wp-login.php", "xmlrpc.php",
)
#: Endings of paths that are not text.
FILE_ENDINGS = (
    "7z", "apk", "avi", "bin", "bmp", "bz2", "css", "dll", "dmg", "doc", "docx", "eot", "exe", "flac", "gif", "gz",
    "ico", "iso", "jar", "jpeg", "jpg", "js", "json", "mkv", "mov", "mp3", "mp4", "mpeg", "msi", "ogg", "otf", "png",
    "ppt", "pptx", "rar", "rpm", "svg", "swf", "tar", "tgz", "tif", "tiff", "ttf", "wav", "webm", "webp", "wmv", "woff",
    "woff2", "xls", "xlsx", "xml", "xz", "zip",
)
#: Ends of hosts whose pages are worth the doubt; a longer rule still blocks.
TRUSTED_ENDS = ("ac.uk", "edu", "edu.au", "gov", "gov.uk", "int", "mil", "museum")


def globs() -> list[tuple[str, str]]:
    """(verdict, pattern) of every rule besides those of words."""
    hosts = [form.format(label) for label in PART_LABELS for form in ("{}.*", "{}.*/**", "*.{}.*", "*.{}.*/**")]
    steps = [form.format(step) for step in FORM_STEPS for form in ("*/{}", "*/{}/**", "*/**/{}", "*/**/{}/**")]
    files = [f"*/**.{ending}" for ending in FILE_ENDINGS]
    trusted = [form.format(end) for end in TRUSTED_ENDS for form in ("*.{}", "*.{}/**")]
    return [("block", pattern) for pattern in hosts + steps + files] + [("allow", pattern) for pattern in trusted]


def rules() -> list[Rule]:
    """The rules of words, then the globs, each named by its pattern."""
    words = [rule for word in BLOCKED_WORDS for rule in word_rule("block", word)]
    return words + [glob(pattern, verdict, pattern) for verdict, pattern in globs()]
