"""Column expressions (JVM-side, codegen-friendly) used by the operators."""

from shelfwatch.functions.text import (  # noqa: F401
    clean_text, trim_all, brand_token, first_match_price, unit_label, discount_percent,
    first_category, encode_list, url_last_segment, url_digits_tail, html_elements,
    html_text, html_first_text, decode_entities, is_product_url,
)
from shelfwatch.functions.numeric import (  # noqa: F401
    money_cents, money_sum, pct_change_2dp, safe_div,
)
from shelfwatch.functions.dates import (  # noqa: F401
    compact_day, date_id, year_of, month_of,
)
