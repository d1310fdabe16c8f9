"""Hand-written archives."""

import gzip


def record(headers, body=b"", version=b"WARC/1.0", eol=b"\r\n", length=None):
    lines = [version] + [f"{k}: {v}".encode() for k, v in headers]
    if length is not False:
        lines.append(b"Content-Length: " + str(len(body) if length is None else length).encode())
    return eol.join(lines) + eol + eol + body + eol + eol


def uuid(n):
    return f"00000000-0000-0000-0000-{n:012x}"


def info(name="f.warc.gz"):
    return record(
        [
            ("WARC-Type", "warcinfo"),
            ("WARC-Date", "2024-02-20T00:00:00Z"),
            ("WARC-Filename", name),
            ("WARC-Record-ID", f"<urn:uuid:{uuid(10)}>"),
            ("Content-Type", "application/warc-fields"),
        ],
        b"isPartOf: own archive\r\n",
    )


def wet(n, body=b"text", **more):
    headers = {
        "WARC-Type": "conversion",
        "WARC-Target-URI": f"http://example.com/{n}",
        "WARC-Date": "2024-02-20T12:34:56Z",
        "WARC-Record-ID": f"<urn:uuid:{uuid(n)}>",
        "WARC-Refers-To": f"<urn:uuid:{uuid(n + 1)}>",
        "WARC-Block-Digest": "sha1:A",
        "Content-Type": "text/plain",
        **more,
    }
    return record([(k, v) for k, v in headers.items() if v is not None], body)


def members(*parts):
    """One gzip member per record, as published archives have it."""
    return b"".join(gzip.compress(part) for part in parts)


def write(folder, name, payload):
    path = folder / name
    path.write_bytes(payload)
    return str(path)
