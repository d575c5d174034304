"""Every SQL-checked key agrees with its DuckDB oracle on sf0.001."""

import pytest

from oracle_check import compare

from small import SMALL_SF

FAST_KEYS = ["feed_counts", "supplier_clean", "filter_numeric", "html_text", "parse_mixed_date", "parse_ymd",
             "org_counter", "drop_audit", "normalise_name", "suppliers", "register_company",
             "register_spine", "fuzzy_top5_jaccard", "fuzzy_top5_lev", "match_candidates_gram"]


@pytest.mark.parametrize("key", FAST_KEYS)
def test_key_matches_oracle(spark, key):
    rep = compare(spark, SMALL_SF, [key])
    assert rep[key].startswith("OK"), rep[key]
