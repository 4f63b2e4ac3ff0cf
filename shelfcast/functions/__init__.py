from .columns import (  # noqa: F401
    rnd, safe_div, seconds_between, iso_dow, title_words, recommend, price_position,
    rfm_segment, stock_band, in_list_position,
)
