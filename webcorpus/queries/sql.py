"""SQL pieces shared by the oracles. They state values by formula and parse nothing."""

from webcorpus import fixtures
from webcorpus.functions.keys import MIX_MULTIPLIER_1, MIX_MULTIPLIER_2


def uuid(text: str) -> str:
    h = f"md5(({text})::VARCHAR)"
    parts = ", ".join(f"substr({h}, {start}, {size})" for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"concat_ws('-', {parts})"


def instant(seconds: str, fmt: str = "%Y-%m-%dT%H:%M:%SZ") -> str:
    return f"strftime(to_timestamp({fixtures.BASE_SECONDS} + {seconds}) AT TIME ZONE 'UTC', '{fmt}')"


def mix64(seed: int, index: str) -> str:
    """The position hash as a scalar expression over ``index``, in 128-bit arithmetic."""
    mask, high = (1 << 64) - 1, 1 << 64
    big = lambda n: f"{n}::UHUGEINT"
    # A list of one carries each intermediate value to the next step.
    step = f"[xor({index}::UHUGEINT, {big(seed)})]"
    rotate = lambda n: f"(((v >> {n}) | ((v << {64 - n}) & {big(mask)})))"
    step = f"list_transform({step}, lambda v: xor(v, xor({rotate(25)}, {rotate(47)})))"
    for multiplier in (MIX_MULTIPLIER_1, MIX_MULTIPLIER_2):
        # The product has up to 128 bits, so it is taken in two halves.
        low, top = multiplier & 0xFFFFFFFF, multiplier >> 32
        product = f"((v * {big(low)}) + (((v * {big(top)}) % {big(1 << 32)}) * {big(1 << 32)})) % {big(high)}"
        step = f"list_transform({step}, lambda v: {product})"
        step = f"list_transform({step}, lambda v: xor(v, xor(v >> 23, v >> 51)))"
    return f"({step})[1]"


def _per_object(table: str, least: int) -> str:
    return f"(SELECT greatest({least}, least({fixtures.LARGEST_OBJECT}, (count(*) + 99) // 100)) AS size FROM {table})"


# One row per page as the WARC archives hold it.
PAGES = f"""
page AS (
    SELECT page_id AS p, url, html,
        page_id // size AS object_index,
        page_id % size + 1 AS record_idx,
        CASE WHEN page_id % 13 = 0
            THEN html || E'\\r\\n\\r\\nWARC/1.0\\r\\nContent-Length: 2\\r\\n\\r\\nxx\\r\\n\\r\\n' || html
            ELSE html END AS body,
        page_id % 3 = 0 AS response
    FROM pages, {_per_object("pages", fixtures.PAGES_PER_OBJECT)}
), warc AS (
    SELECT *,
        printf('0101%08x', object_index) AS object_key,
        {uuid("p")} AS record_id,
        CASE p % 3 WHEN 0 THEN 'response' WHEN 1 THEN 'request' ELSE 'metadata' END AS warc_type,
        CASE WHEN p % 5 <> 0 AND p % 7 = 0 THEN {instant("p", "%Y-%m-%dT%H:%M:%S.250Z")} ELSE {instant("p")} END AS date,
        CASE WHEN p % 6 = 2 THEN NULL
            WHEN p % 17 = 0 THEN NULL
            WHEN p % 11 = 3 THEN printf('http://example.com/p%d', p)
            WHEN p % 13 = 5 THEN printf('http://example.com/p%%20%d/%%C3%%A9', p)
            ELSE url END AS target_uri,
        CASE WHEN NOT response THEN NULL
            WHEN p % 4 = 0 THEN printf('2606:2800::%x:1', p % 16 + 1)
            ELSE printf('10.%d.%d.1', (p // 256) % 256, p % 256) END AS ip_address,
        CASE WHEN p % 3 <> 0 THEN {uuid("p - p % 3")} END AS concurrent_to,
        CASE WHEN response THEN {uuid("'warc:' || object_index")} END AS warcinfo_id,
        CASE WHEN p % 23 = 0 THEN 'missing header: WARC-Record-ID'
            WHEN p % 17 = 0 AND p % 6 <> 2 THEN 'bad target_uri'
            WHEN p % 19 = 0 AND response THEN 'bad ip_address' END AS reject_reason
    FROM page
)"""

# One row per text document as the WET archives hold it.
DOCUMENTS = f"""
wet AS (
    SELECT doc_id AS d, text, lang,
        doc_id // size AS object_index,
        doc_id % size + 1 AS record_idx,
        printf('0103%08x', doc_id // size) AS object_key,
        {uuid("text")} AS record_id
    FROM documents, {_per_object("documents", fixtures.DOCUMENTS_PER_OBJECT)}
)"""
