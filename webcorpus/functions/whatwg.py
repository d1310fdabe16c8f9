"""Per-value helper for the URLs that need escaping, host work or dot-segment removal.

Covers the URL Standard for absolute URLs. International host names use NFKC, lower case and
Punycode per label, which is the standard's mapping for the names found in practice but not its
whole table.
"""

from __future__ import annotations

import ipaddress
import re
import unicodedata
from urllib.parse import unquote_to_bytes

# The special schemes with their default ports.
DEFAULT_PORTS = {"ftp": 21, "file": None, "http": 80, "https": 443, "ws": 80, "wss": 443}

# ASCII characters escaped in each part, besides controls and non-ASCII.
ESCAPE_FRAGMENT = ' "<>`'
ESCAPE_QUERY = ' "#<>'
ESCAPE_SPECIAL_QUERY = ' "#<>\''
ESCAPE_PATH = ' "#<>?`{}'
ESCAPE_USERINFO = ' "#<>?`{}/:;=@[\\]^|'

_SCHEME = re.compile(r"([A-Za-z][A-Za-z0-9+.\-]*):")
_FORBIDDEN_HOST = re.compile(r"[\x00\t\n\r #/:<>?@\[\\\]^|]")
_FORBIDDEN_DOMAIN = re.compile(r"[\x00-\x20#/:<>?@\[\\\]^|%\x7f]")
_NUMBER = re.compile(r"0[xX][0-9a-fA-F]*\Z|[0-9]+\Z")
_CONTROLS = "".join(map(chr, range(0x21)))


def escape(text: str, special: str) -> str:
    if text.isascii() and text.isprintable() and not any(c in special for c in text):
        return text
    return "".join(
        c
        if " " <= c <= "~" and c not in special
        else "".join(f"%{byte:02X}" for byte in c.encode("utf-8", "replace"))
        for c in text
    )


def normalise(url: str) -> str | None:
    url = re.sub(r"[\t\n\r]", "", url.strip(_CONTROLS))
    match = _SCHEME.match(url)
    if not match:
        return None
    scheme, rest = match.group(1).lower(), url[match.end() :]
    rest, hash_mark, fragment = rest.partition("#")
    tail = f"#{escape(fragment, ESCAPE_FRAGMENT)}" if hash_mark else ""
    rest, query_mark, query = rest.partition("?")
    special = scheme in DEFAULT_PORTS
    if query_mark:
        tail = f"?{escape(query, ESCAPE_SPECIAL_QUERY if special else ESCAPE_QUERY)}{tail}"
    if special:
        rest = rest.replace("\\", "/")
        if scheme == "file":
            head = _file(rest)
        else:
            head = _authority(scheme, rest.lstrip("/"), special=True)
    elif rest.startswith("//"):
        head = _authority(scheme, rest[2:], special=False)
    elif rest.startswith("/"):
        path = _path(rest, special=False)
        head = f"/.{path}" if path.startswith("//") else path
    else:
        head = escape(rest, "")
    return None if head is None else f"{scheme}:{head}{tail}"


def _authority(scheme: str, rest: str, special: bool) -> str | None:
    authority, slash, path = rest.partition("/")
    userinfo, at, hostport = authority.rpartition("@")
    match = re.fullmatch(r"(\[[^\]]*\]|[^:]*)(?::([0-9]*))?", hostport)
    if not match or (not match.group(1) and (special or at or match.group(2) is not None)):
        return None
    host = _host(match.group(1), special)
    if host is None:
        return None
    port = int(match.group(2)) if match.group(2) else None
    if port is not None and port > 65535:
        return None
    port_text = "" if port is None or port == DEFAULT_PORTS.get(scheme) else f":{port}"
    return f"//{_userinfo(userinfo)}{host}{port_text}{_path(slash + path, special)}"


def _userinfo(text: str) -> str:
    name, _, password = text.partition(":")
    name, password = escape(name, ESCAPE_USERINFO), escape(password, ESCAPE_USERINFO)
    if password:
        return f"{name}:{password}@"
    return f"{name}@" if name else ""


def _file(rest: str) -> str | None:
    host, path = "", rest
    if rest.startswith("//"):
        host, slash, path = rest[2:].partition("/")
        path = slash + path
        if re.fullmatch(r"[A-Za-z][:|]", host):
            host, path = "", f"/{host}{path}"
        elif host:
            host = _host(host, special=True)
            if host is None:
                return None
            host = "" if host == "localhost" else host
    path = re.sub(r"^/?([A-Za-z])[:|](?=/|\Z)", r"/\1:", path)
    return f"//{host}{_path(path, special=True, drive=True)}"


def _path(path: str, special: bool, drive: bool = False) -> str:
    if not path:
        return "/" if special else ""
    segments = path.split("/")
    if path.startswith("/"):
        segments = segments[1:]
    kept: list[str] = []
    for i, segment in enumerate(segments):
        last = i == len(segments) - 1
        dots = re.sub("%2e", ".", segment, flags=re.IGNORECASE)
        if dots == "..":
            if kept and not (drive and len(kept) == 1 and re.fullmatch("[A-Za-z]:", kept[0])):
                kept.pop()
        elif dots != ".":
            kept.append(escape(segment, ESCAPE_PATH))
            continue
        if last:
            kept.append("")
    return "/" + "/".join(kept)


def _host(text: str, special: bool) -> str | None:
    if text.startswith("["):
        try:
            return None if "%" in text else f"[{_ipv6(text[1:-1])}]"
        except ValueError:
            return None
    if not special:
        return None if _FORBIDDEN_HOST.search(text) else escape(text, "")
    try:
        decoded = unquote_to_bytes(text.encode("utf-8")).decode("utf-8")
        host = _to_ascii(decoded)
    except UnicodeError:
        return None
    if not host or _FORBIDDEN_DOMAIN.search(host):
        return None
    labels = host.split(".")
    if labels[-1] == "" and len(labels) > 1:
        labels = labels[:-1]
    return _ipv4(labels) if _NUMBER.match(labels[-1]) else host


def _to_ascii(host: str) -> str:
    if host.isascii():
        return host.lower()
    mapped = unicodedata.normalize("NFKC", host.replace("\u00ad", "")).lower()
    mapped = unicodedata.normalize("NFC", re.sub("[\u3002\uff0e\uff61]", ".", mapped))
    return ".".join(
        label if label.isascii() else "xn--" + label.encode("punycode").decode("ascii")
        for label in mapped.split(".")
    )


def _ipv4(labels: list[str]) -> str | None:
    if len(labels) > 4:
        return None
    numbers = []
    for label in labels:
        if re.fullmatch(r"0[xX][0-9a-fA-F]*", label):
            numbers.append(int(label[2:] or "0", 16))
        elif re.fullmatch(r"0[0-7]*", label):
            numbers.append(int(label, 8))
        elif re.fullmatch(r"[1-9][0-9]*", label):
            numbers.append(int(label))
        else:
            return None
    *leading, last = numbers
    if any(n > 255 for n in leading) or last >= 256 ** (4 - len(leading)):
        return None
    value = last + sum(n << 8 * (3 - i) for i, n in enumerate(leading))
    return str(ipaddress.IPv4Address(value))


def _ipv6(text: str) -> str:
    """Hex groups with the longest run of zeros shortened; a mapped IPv4 part stays in hex."""
    groups = ipaddress.IPv6Address(text).exploded.split(":")
    joined = ":".join(format(int(group, 16), "x") for group in groups)
    for run in range(8, 1, -1):
        match = re.search(rf"(?:^|:)0(?::0){{{run - 1}}}(?=:|\Z):?", joined)
        if match:
            return f"{joined[: match.start()]}::{joined[match.end() :]}"
    return joined
