"""Output columns of every report, in order (see functions.present)."""

# Views, rounded for display.
VIEWS = {
    "view_order_summary": "order_key order_id order_date order_year order_month order_year_month ship_date shipping_days ship_mode customer_id customer_name segment country state city postal_code region total_order_lines distinct_products total_sales:6 total_quantity average_line_discount:6 total_profit:6 unknown_sales_lines unknown_quantity_lines unknown_profit_lines",
    "view_monthly_performance": "order_year order_month order_year_month total_orders distinct_customers total_order_lines total_product_references total_sales:6 total_quantity total_profit:6 average_complete_order_value:6 average_complete_order_profit:6 profit_margin_percentage:6 unknown_sales_lines unknown_quantity_lines unknown_profit_lines orders_with_unknown_sales orders_with_unknown_profit",
    "view_subcategory_performance": "category sub_category total_order_lines total_orders distinct_customers distinct_products total_sales:6 total_quantity total_profit:6 average_line_discount:6 comparable_profit_margin_percentage:6 unknown_sales_lines unknown_quantity_lines unknown_profit_lines loss_making_lines",
    "view_customer_performance": "customer_id customer_name segment total_orders first_order_date last_order_date purchase_span_days distinct_locations total_order_lines total_product_references total_sales:6 total_quantity total_profit:6 average_complete_order_value:6 comparable_profit_margin_percentage:6 average_shipping_days:6 unknown_sales_lines unknown_quantity_lines unknown_profit_lines orders_with_unknown_sales orders_with_unknown_profit complete_loss_making_orders",
    "view_geographic_performance": "region country state city distinct_postal_codes total_orders distinct_customers total_order_lines total_sales:6 total_quantity total_profit:6 average_complete_order_value:6 comparable_profit_margin_percentage:6 average_shipping_days:6 minimum_shipping_days maximum_shipping_days unknown_sales_lines unknown_quantity_lines unknown_profit_lines orders_with_unknown_sales orders_with_unknown_profit complete_loss_making_orders",
    "view_product_performance": "product_key product_id product_name category sub_category first_order_date last_order_date total_order_lines total_orders distinct_customers total_sales:6 total_quantity total_profit:6 average_line_discount:6 comparable_average_unit_sales:6 comparable_profit_margin_percentage:6 unknown_sales_lines unknown_quantity_lines unknown_profit_lines loss_making_lines",
    "view_segment_performance": "segment first_order_date last_order_date total_orders distinct_customers total_order_lines total_product_references total_sales:6 total_quantity total_profit:6 average_complete_order_value:6 average_complete_order_profit:6 comparable_profit_margin_percentage:6 average_shipping_days:6 minimum_shipping_days maximum_shipping_days unknown_sales_lines unknown_quantity_lines unknown_profit_lines orders_with_unknown_sales orders_with_unknown_quantity orders_with_unknown_profit complete_loss_making_orders",
    "view_category_performance": "category first_order_date last_order_date total_order_lines total_orders distinct_customers distinct_products distinct_subcategories total_sales:6 total_quantity total_profit:6 average_line_discount:6 average_known_line_sales:6 average_known_line_profit:6 comparable_profit_margin_percentage:6 unknown_sales_lines unknown_quantity_lines unknown_profit_lines loss_making_lines",
}
VIEWS["view_ship_mode_performance"] = VIEWS["view_segment_performance"].replace("segment ", "ship_mode is_unknown_ship_mode ", 1)

_OVERVIEW = "first_order_date last_order_date analysis_period_days total_orders total_customers total_products total_categories total_subcategories total_locations total_regions total_order_lines total_sales{0} total_quantity total_profit{0} average_complete_order_value{0} average_complete_order_profit{0} comparable_profit_margin_percentage{0} average_orders_per_customer{0} average_shipping_days{0} minimum_shipping_days maximum_shipping_days unknown_sales_lines unknown_quantity_lines unknown_profit_lines sales_coverage_percentage{0} quantity_coverage_percentage{0} profit_coverage_percentage{0} orders_with_unknown_sales orders_with_unknown_quantity orders_with_unknown_profit orders_with_unknown_ship_mode complete_loss_making_orders"
VIEWS["view_business_overview"] = _OVERVIEW.format(":6")

BUSINESS = {
    "executive_kpis": _OVERVIEW.format("").replace("unknown_sales_lines unknown_quantity_lines unknown_profit_lines ", "") + " complete_loss_making_order_percentage unknown_ship_mode_percentage",
    "annual_performance": "order_year total_orders distinct_customers total_order_lines total_sales total_quantity total_profit average_complete_order_value average_complete_order_profit comparable_profit_margin_percentage year_over_year_order_growth_percentage year_over_year_customer_growth_percentage year_over_year_sales_growth_percentage year_over_year_profit_change sales_coverage_percentage quantity_coverage_percentage profit_coverage_percentage complete_loss_making_orders",
    "monthly_growth": "order_year order_month order_year_month total_orders distinct_customers total_order_lines total_sales total_quantity total_profit average_complete_order_value average_complete_order_profit profit_margin_percentage month_over_month_order_growth_percentage month_over_month_customer_growth_percentage month_over_month_sales_growth_percentage month_over_month_profit_change sales_coverage_percentage quantity_coverage_percentage profit_coverage_percentage orders_with_unknown_sales orders_with_unknown_profit",
    "month_ranking": "order_year_month total_orders distinct_customers total_sales total_quantity total_profit average_complete_order_value profit_margin_percentage sales_rank_best sales_rank_worst profit_rank_best profit_rank_worst order_rank_best order_rank_worst sales_coverage_percentage profit_coverage_percentage",
    "top_months_by_sales": "order_year_month total_orders distinct_customers total_sales total_profit profit_margin_percentage",
    "top_months_by_profit": "order_year_month total_orders total_sales total_profit profit_margin_percentage",
    "bottom_months_by_profit": "order_year_month total_orders total_sales total_profit profit_margin_percentage unknown_profit_lines",
    "seasonality": "order_month month_name observed_periods observed_years average_orders average_distinct_customers average_sales average_quantity average_profit average_complete_order_value minimum_sales maximum_sales minimum_profit maximum_profit average_sales_rank average_profit_rank average_orders_rank average_sales_coverage_percentage average_profit_coverage_percentage",
    "months_by_average_sales": "order_month month_name observed_years average_sales average_profit average_orders",
}

CATEGORY = {
    "category_comparison": "category total_orders total_order_lines distinct_customers distinct_products distinct_subcategories total_sales total_quantity total_profit average_line_discount average_known_line_sales average_known_line_profit comparable_profit_margin_percentage sales_share_percentage quantity_share_percentage order_line_share_percentage sales_rank profit_rank margin_rank loss_making_lines known_loss_making_line_percentage sales_coverage_percentage quantity_coverage_percentage profit_coverage_percentage",
    "category_rank_gap": "category total_orders total_order_lines total_sales total_profit average_line_discount comparable_profit_margin_percentage sales_rank profit_rank margin_rank sales_profit_rank_gap profitability_vs_sales known_loss_making_line_percentage sales_coverage_percentage profit_coverage_percentage",
    "category_by_margin": "category total_sales total_profit comparable_profit_margin_percentage average_line_discount loss_making_lines known_loss_making_line_percentage",
    "category_discount_bands": "category discount_range total_orders total_order_lines distinct_customers average_discount_percentage total_sales total_quantity total_profit average_known_line_sales average_known_line_profit comparable_profit_margin_percentage loss_making_lines known_loss_making_line_percentage sales_coverage_percentage profit_coverage_percentage",
    "category_loss_discounts": "category discount total_order_lines total_sales total_profit average_known_profit loss_making_lines",
    "category_yearly": "category order_year total_orders distinct_customers total_order_lines distinct_products total_sales total_quantity total_profit average_line_discount comparable_profit_margin_percentage year_over_year_order_growth_percentage year_over_year_sales_growth_percentage year_over_year_profit_change loss_making_lines known_loss_making_line_percentage sales_coverage_percentage quantity_coverage_percentage profit_coverage_percentage",
    "subcategory_comparison": "category sub_category total_orders total_order_lines distinct_customers distinct_products total_sales total_quantity total_profit average_line_discount comparable_profit_margin_percentage global_sales_share_percentage global_profit_share_percentage category_sales_share_percentage global_sales_rank global_profit_rank global_margin_rank category_sales_rank sales_profit_rank_gap loss_making_lines known_loss_making_line_percentage sales_coverage_percentage quantity_coverage_percentage profit_coverage_percentage",
    "subcategory_quadrant": "category sub_category performance_profile total_orders total_order_lines distinct_customers distinct_products total_sales sales_benchmark sales_vs_benchmark total_quantity total_profit comparable_profit_margin_percentage margin_benchmark margin_vs_benchmark_points average_line_discount known_loss_making_line_percentage sales_coverage_percentage profit_coverage_percentage",
    "subcategory_high_volume_low_margin": "category sub_category total_sales total_profit comparable_profit_margin_percentage average_line_discount loss_making_lines known_loss_making_line_percentage",
    "subcategory_pareto": "sales_position category sub_category total_orders total_order_lines distinct_customers distinct_products total_sales sales_share_percentage cumulative_sales cumulative_sales_percentage abc_classification total_profit comparable_profit_margin_percentage sales_coverage_percentage profit_coverage_percentage",
    "subcategory_risk": "category sub_category risk_status total_orders total_order_lines known_profit_lines loss_making_lines known_loss_making_line_percentage total_sales total_profit comparable_profit_margin_percentage average_discount_percentage lowest_profit_rank loss_frequency_rank sales_coverage_percentage profit_coverage_percentage",
    "subcategory_negative_profit": "category sub_category total_orders total_order_lines total_sales total_profit comparable_profit_margin_percentage average_discount_percentage loss_making_lines known_loss_making_line_percentage profit_coverage_percentage",
    "subcategory_top_loss_lines": "category sub_category total_order_lines loss_making_lines known_loss_making_line_percentage total_sales total_profit comparable_profit_margin_percentage average_discount_percentage",
    "subcategory_yearly": "category sub_category order_year total_orders distinct_customers total_order_lines distinct_products total_sales total_quantity total_profit average_discount_percentage comparable_profit_margin_percentage year_over_year_order_growth_percentage year_over_year_sales_growth_percentage year_over_year_profit_change year_over_year_margin_change_points loss_making_lines known_loss_making_line_percentage sales_coverage_percentage quantity_coverage_percentage profit_coverage_percentage",
    "subcategory_growth_margin_drop": "category sub_category order_year previous_year_sales total_sales sales_growth_percentage previous_year_margin current_margin margin_change_points",
}

_PRODUCT = "product_key product_id product_name category sub_category"
PRODUCT = {
    "product_ranking": f"{_PRODUCT} first_order_date last_order_date total_orders total_order_lines distinct_customers total_sales total_quantity total_profit average_discount_percentage comparable_average_unit_sales comparable_profit_margin_percentage global_sales_share_percentage:4 global_sales_rank global_profit_rank global_margin_rank subcategory_sales_rank sales_profit_rank_gap loss_making_lines known_loss_making_line_percentage sales_coverage_percentage quantity_coverage_percentage profit_coverage_percentage",
    "top_products_by_sales": f"{_PRODUCT} total_orders distinct_customers total_sales total_quantity total_profit comparable_profit_margin_percentage loss_making_lines sales_coverage_percentage profit_coverage_percentage",
    "top_products_by_profit": f"{_PRODUCT} total_orders total_sales total_profit comparable_profit_margin_percentage average_discount_percentage loss_making_lines",
    "product_quadrant": f"{_PRODUCT} performance_profile profitability_status total_orders total_order_lines distinct_customers total_sales sales_benchmark sales_vs_benchmark total_quantity total_profit comparable_profit_margin_percentage margin_benchmark margin_vs_benchmark_points average_discount_percentage loss_making_lines known_loss_making_line_percentage sales_coverage_percentage profit_coverage_percentage",
    "product_high_volume_low_margin": f"{_PRODUCT} total_orders distinct_customers total_sales total_profit comparable_profit_margin_percentage margin_benchmark margin_vs_benchmark_points average_discount_percentage loss_making_lines known_loss_making_line_percentage profit_coverage_percentage",
    "product_negative_profit": f"{_PRODUCT} total_orders total_order_lines total_sales total_profit comparable_profit_margin_percentage average_discount_percentage loss_making_lines known_loss_making_line_percentage profit_coverage_percentage",
    "product_pareto": f"sales_position {_PRODUCT} total_orders total_order_lines distinct_customers total_sales sales_share_percentage:4 cumulative_sales cumulative_sales_percentage abc_classification total_profit comparable_profit_margin_percentage sales_coverage_percentage profit_coverage_percentage",
    "product_reused_codes": "product_id associated_products product_key product_name category sub_category total_orders total_order_lines distinct_customers total_sales total_quantity total_profit average_discount_percentage comparable_profit_margin_percentage sales_rank_within_source_id source_id_sales_share_percentage loss_making_lines known_loss_making_line_percentage sales_coverage_percentage profit_coverage_percentage",
    "product_yearly": f"{_PRODUCT} order_year total_orders distinct_customers total_order_lines total_sales total_quantity total_profit average_discount_percentage comparable_profit_margin_percentage year_over_year_order_growth_percentage year_over_year_sales_growth_percentage year_over_year_profit_change year_over_year_margin_change_points loss_making_lines known_loss_making_line_percentage sales_coverage_percentage quantity_coverage_percentage profit_coverage_percentage",
    "product_growth_margin_drop": f"{_PRODUCT} order_year previous_year_sales current_year_sales sales_growth_percentage previous_year_profit current_year_profit profit_change previous_year_margin current_year_margin margin_change_points",
    "product_profit_flip": f"{_PRODUCT} order_year previous_year_profit current_year_profit profit_change unknown_profit_lines",
}

_CUSTOMER = "customer_id customer_name segment"
CUSTOMER = {
    "customer_ranking": f"{_CUSTOMER} total_orders first_order_date last_order_date purchase_span_days distinct_locations total_order_lines total_product_references total_sales total_quantity total_profit average_complete_order_value comparable_profit_margin_percentage average_shipping_days global_sales_share_percentage:4 sales_rank profit_rank order_frequency_rank average_order_value_rank sales_profit_rank_gap complete_loss_making_orders complete_loss_making_order_percentage sales_coverage_percentage quantity_coverage_percentage profit_coverage_percentage",
    "top_customers_by_sales": f"{_CUSTOMER} total_orders first_order_date last_order_date total_sales total_profit average_complete_order_value comparable_profit_margin_percentage complete_loss_making_orders",
    "customer_value_frequency": f"{_CUSTOMER} customer_profile total_orders first_order_date last_order_date purchase_span_days total_sales total_profit average_complete_order_value comparable_profit_margin_percentage complete_loss_making_orders value_group frequency_group sales_coverage_percentage profit_coverage_percentage",
    "customer_rfm": f"{_CUSTOMER} analysis_reference_date last_order_date recency_days total_orders total_sales total_profit average_complete_order_value comparable_profit_margin_percentage recency_score frequency_score monetary_score rfm_code rfm_total_score rfm_segment sales_coverage_percentage profit_coverage_percentage",
    "customer_profitability": f"{_CUSTOMER} profitability_profile loss_status total_orders first_order_date last_order_date purchase_span_days total_sales sales_benchmark sales_vs_benchmark total_quantity total_profit comparable_profit_margin_percentage margin_benchmark margin_vs_benchmark_points average_complete_order_value complete_loss_making_orders complete_loss_making_order_percentage sales_coverage_percentage profit_coverage_percentage",
    "customer_high_sales_low_margin": f"{_CUSTOMER} total_orders total_sales total_profit average_complete_order_value comparable_profit_margin_percentage margin_benchmark margin_vs_benchmark_points complete_loss_making_orders complete_loss_making_order_percentage profit_coverage_percentage",
    "customer_negative_profit": f"{_CUSTOMER} total_orders total_sales total_profit comparable_profit_margin_percentage average_complete_order_value complete_loss_making_orders complete_loss_making_order_percentage profit_coverage_percentage",
    "customer_loss_orders": f"{_CUSTOMER} total_orders complete_loss_making_orders complete_loss_making_order_percentage total_sales total_profit comparable_profit_margin_percentage profit_coverage_percentage",
    "customer_recurrence": f"{_CUSTOMER} recurrence_profile total_orders first_order_date last_order_date customer_lifetime_days active_months active_years total_sales total_profit average_known_sales_per_order sales_coverage_percentage profit_coverage_percentage",
    "segment_comparison": "segment total_customers total_orders average_orders_per_customer total_order_lines total_sales average_sales_per_customer total_profit average_profit_per_customer average_customer_order_value comparable_profit_margin_percentage sales_rank profit_rank customer_value_rank repeat_customers one_time_customers repeat_customer_percentage multi_year_customers multi_year_customer_percentage average_purchase_span_days customers_with_negative_profit negative_profit_customer_percentage complete_loss_making_orders sales_coverage_percentage profit_coverage_percentage",
}

_CITY = "region country state city"
_SHIP = "average_shipping_days minimum_shipping_days maximum_shipping_days"
_LOSS = "complete_loss_making_orders complete_loss_making_order_percentage"
_COVER = "sales_coverage_percentage quantity_coverage_percentage profit_coverage_percentage"
GEOGRAPHY = {
    "city_ranking": f"{_CITY} distinct_postal_codes total_orders distinct_customers total_order_lines total_sales total_quantity total_profit average_complete_order_value comparable_profit_margin_percentage {_SHIP} global_sales_share_percentage:4 sales_rank profit_rank margin_rank regional_sales_rank sales_profit_rank_gap {_LOSS} {_COVER}",
    "top_cities_by_sales": f"{_CITY} total_orders distinct_customers total_sales total_profit average_complete_order_value comparable_profit_margin_percentage average_shipping_days complete_loss_making_orders sales_coverage_percentage profit_coverage_percentage",
    "top_cities_by_profit": f"{_CITY} total_orders distinct_customers total_sales total_profit comparable_profit_margin_percentage average_shipping_days",
    "city_quadrant": f"{_CITY} geographic_profile profitability_status distinct_postal_codes total_orders distinct_customers total_order_lines total_sales sales_benchmark sales_vs_benchmark total_quantity total_profit comparable_profit_margin_percentage margin_benchmark margin_vs_benchmark_points average_complete_order_value average_shipping_days {_LOSS} sales_coverage_percentage profit_coverage_percentage",
    "region_performance": f"region total_orders distinct_customers total_order_lines total_sales sales_share_percentage order_share_percentage total_quantity total_profit average_complete_order_value comparable_profit_margin_percentage sales_rank profit_rank margin_rank sales_profit_rank_gap {_SHIP} {_LOSS} {_COVER}",
    "state_performance": f"region country state distinct_cities total_orders distinct_customers total_order_lines total_sales global_sales_share_percentage total_quantity total_profit average_complete_order_value comparable_profit_margin_percentage global_sales_rank global_profit_rank global_margin_rank regional_sales_rank regional_profit_rank country_sales_rank sales_profit_rank_gap {_SHIP} {_LOSS} {_COVER}",
    "top_states": "region country state total_orders distinct_customers distinct_cities total_sales total_profit average_complete_order_value comparable_profit_margin_percentage average_shipping_days complete_loss_making_orders",
    "state_negative_profit": f"region country state total_orders distinct_customers total_sales total_profit {_LOSS} profit_coverage_percentage",
    "country_performance": f"country distinct_regions distinct_states distinct_cities total_orders distinct_customers total_order_lines total_sales sales_share_percentage order_share_percentage customer_presence_share_percentage total_quantity total_profit average_complete_order_value comparable_profit_margin_percentage sales_rank profit_rank margin_rank average_order_value_rank sales_profit_rank_gap {_SHIP} {_LOSS} {_COVER}",
    "country_negative_profit": f"country total_orders distinct_customers total_sales total_profit {_LOSS} profit_coverage_percentage",
    "city_abc": f"city_position {_CITY} total_orders distinct_customers total_sales total_profit comparable_profit_margin_percentage sales_share_percentage:4 cumulative_sales_percentage abc_class",
    "region_yearly": f"region order_year total_orders distinct_customers total_order_lines total_sales total_quantity total_profit average_complete_order_value comparable_profit_margin_percentage yoy_order_growth_percentage yoy_customer_growth_percentage yoy_sales_growth_percentage yoy_profit_absolute_change yoy_margin_change_points {_LOSS} {_COVER}",
    "region_growth_margin_drop": "region order_year previous_year_sales total_sales yoy_sales_growth_percentage previous_year_profit total_profit yoy_profit_absolute_change previous_year_margin comparable_profit_margin_percentage yoy_margin_change_points",
    "city_loss_concentration": f"loss_position {_CITY} total_orders distinct_customers total_sales total_profit known_loss_amount comparable_profit_margin_percentage loss_share_percentage cumulative_loss_percentage loss_concentration_class {_LOSS} profit_coverage_percentage",
    "top_city_losses": f"{_CITY} total_orders distinct_customers total_sales total_profit known_loss_amount comparable_profit_margin_percentage {_LOSS} profit_coverage_percentage",
    "city_high_sales_loss": f"{_CITY} total_orders distinct_customers total_sales average_city_sales sales_above_average total_profit comparable_profit_margin_percentage complete_loss_making_orders profit_coverage_percentage",
}

_DAYS = "average_shipping_days minimum_shipping_days maximum_shipping_days shipping_days_stddev"
_FAST = "same_day_orders same_day_percentage two_day_or_less_orders two_day_or_less_percentage eight_plus_day_orders eight_plus_day_percentage"
LOGISTICS = {
    "ship_mode_ranking": f"ship_mode is_unknown_ship_mode total_orders order_share_percentage distinct_customers total_order_lines total_sales sales_share_percentage total_quantity total_profit average_complete_order_value comparable_profit_margin_percentage {_SHIP} usage_rank shipping_speed_rank sales_rank profit_rank sales_profit_rank_gap {_LOSS} {_COVER}",
    "ship_mode_distribution": f"ship_mode is_unknown_ship_mode total_orders order_share_percentage {_SHIP}",
    "shipping_bands": f"shipping_time_group minimum_shipping_days maximum_shipping_days average_shipping_days total_orders order_share_percentage distinct_customers total_order_lines total_sales sales_share_percentage total_quantity total_profit average_complete_order_value comparable_profit_margin_percentage {_LOSS} {_COVER}",
    "shipping_day_histogram": "shipping_days total_orders order_share_percentage total_sales total_profit average_known_sales_per_order",
    "long_shipping_orders": "order_key order_id order_date ship_date shipping_days ship_mode customer_id customer_name region country state city total_order_lines total_sales total_profit unknown_sales_lines unknown_profit_lines",
    "mode_by_band": f"ship_mode shipping_time_group total_orders within_ship_mode_order_percentage within_time_group_order_percentage distinct_customers total_order_lines total_sales total_quantity total_profit average_shipping_days comparable_profit_margin_percentage complete_loss_making_orders {_COVER}",
    "mode_band_wide": f"ship_mode total_orders {_SHIP} same_day_orders same_day_percentage one_two_day_orders one_two_day_percentage three_four_day_orders three_four_day_percentage five_seven_day_orders five_seven_day_percentage eight_plus_day_orders eight_plus_day_percentage",
    "region_logistics": f"region total_orders distinct_customers total_order_lines average_shipping_days global_average_shipping_days shipping_days_vs_global_average minimum_shipping_days maximum_shipping_days shipping_days_stddev shipping_speed_rank same_day_orders same_day_percentage two_day_or_less_orders two_day_or_less_percentage eight_plus_day_orders eight_plus_day_percentage long_shipping_rank total_sales total_profit {_LOSS} sales_coverage_percentage profit_coverage_percentage",
    "slow_regions": "region total_orders average_shipping_days global_average_shipping_days shipping_days_above_average shipping_days_stddev eight_plus_day_orders eight_plus_day_percentage total_sales total_profit",
    "country_logistics": f"country total_orders distinct_customers distinct_states distinct_cities total_order_lines average_shipping_days global_average_shipping_days shipping_days_vs_global_average minimum_shipping_days maximum_shipping_days shipping_days_stddev global_shipping_days_stddev shipping_speed_rank shipping_consistency_rank same_day_orders same_day_percentage two_day_or_less_orders two_day_or_less_percentage eight_plus_day_orders eight_plus_day_percentage long_shipping_rank unknown_ship_mode_orders unknown_ship_mode_percentage total_sales total_profit {_LOSS} sales_coverage_percentage profit_coverage_percentage",
    "slow_countries": "country total_orders average_shipping_days global_average_shipping_days shipping_days_above_average shipping_days_stddev eight_plus_day_orders eight_plus_day_percentage total_sales total_profit",
    "annual_logistics": f"order_year total_orders distinct_customers {_DAYS} {_FAST} unknown_ship_mode_orders unknown_ship_mode_percentage total_sales total_profit yoy_order_growth_percentage yoy_average_shipping_days_change yoy_shipping_stddev_change yoy_same_day_change_points yoy_two_day_or_less_change_points yoy_eight_plus_day_change_points yoy_unknown_ship_mode_change_points",
    "logistics_evolution": "order_year total_orders average_shipping_days average_shipping_days_change two_day_or_less_percentage two_day_or_less_change_points eight_plus_day_percentage eight_plus_day_change_points shipping_days_stddev logistics_evolution",
    "monthly_logistics": f"order_year order_month order_year_month total_orders distinct_customers {_DAYS} {_FAST} unknown_ship_mode_orders unknown_ship_mode_percentage total_sales total_profit mom_average_shipping_days_change mom_two_day_or_less_change_points mom_eight_plus_day_change_points",
    "logistics_seasonality": f"calendar_month month_name observed_years total_orders {_DAYS} shipping_speed_rank {_FAST} long_shipping_rank unknown_ship_mode_orders unknown_ship_mode_percentage",
    "months_by_shipping_time": "calendar_month month_name total_orders average_shipping_days shipping_days_stddev eight_plus_day_percentage",
    "shipping_vs_commercial": f"shipping_time_group total_orders order_share_percentage distinct_customers total_order_lines total_sales total_quantity total_profit average_complete_order_value global_average_complete_order_value order_value_vs_global_average average_complete_order_profit comparable_profit_margin_percentage global_comparable_profit_margin_percentage margin_vs_global_average_points average_order_value_rank profitability_rank {_LOSS} {_COVER}",
    "commercial_by_day": f"shipping_days total_orders order_share_percentage average_complete_order_value average_complete_order_profit comparable_profit_margin_percentage {_LOSS}",
    "logistics_extremes": "logistics_group total_orders average_complete_order_value average_complete_order_profit comparable_profit_margin_percentage complete_loss_making_order_percentage",
    "region_mode": f"region ship_mode is_unknown_ship_mode total_orders regional_ship_mode_percentage ship_mode_region_percentage distinct_customers total_order_lines average_shipping_days ship_mode_average_shipping_days shipping_days_vs_ship_mode_average minimum_shipping_days maximum_shipping_days shipping_days_stddev regional_speed_rank_within_ship_mode {_FAST} total_sales total_quantity total_profit comparable_profit_margin_percentage {_LOSS} {_COVER}",
    "slow_region_modes": "region ship_mode total_orders average_shipping_days ship_mode_average_shipping_days shipping_days_above_ship_mode_average shipping_days_stddev eight_plus_day_orders eight_plus_day_percentage",
    "country_mode": "country ship_mode total_orders average_shipping_days ship_mode_average_shipping_days shipping_days_vs_ship_mode_average shipping_days_stddev two_day_or_less_percentage eight_plus_day_percentage country_speed_rank_within_ship_mode",
    "logistics_summary": f"total_orders {_DAYS} {_FAST} unknown_ship_mode_orders unknown_ship_mode_percentage total_sales total_profit",
}

_PERIOD = "requested_start_date requested_end_date"
PERIOD = {
    "period_sales_summary": f"{_PERIOD} first_observed_order_date last_observed_order_date total_orders distinct_customers total_order_lines total_product_references total_sales total_quantity total_profit average_complete_order_value comparable_profit_margin_percentage {_SHIP} unknown_sales_lines unknown_quantity_lines unknown_profit_lines orders_with_unknown_sales orders_with_unknown_profit orders_with_unknown_ship_mode complete_loss_making_orders",
    "period_category_performance": f"category sub_category {_PERIOD} first_observed_order_date last_observed_order_date total_orders distinct_customers distinct_products total_order_lines total_sales total_quantity total_profit average_discount comparable_profit_margin_percentage loss_making_lines known_loss_line_percentage unknown_sales_lines unknown_quantity_lines unknown_profit_lines {_COVER}",
    "period_top_products": f"sales_position {_PRODUCT} {_PERIOD} total_orders distinct_customers total_order_lines total_sales total_quantity total_profit average_discount comparable_profit_margin_percentage profit_rank margin_rank sales_profit_rank_gap loss_making_lines known_loss_line_percentage unknown_sales_lines unknown_quantity_lines unknown_profit_lines {_COVER}",
    "period_top_customers": f"sales_position {_CUSTOMER} {_PERIOD} first_order_date last_order_date purchase_span_days active_months active_years total_orders order_frequency_rank total_order_lines total_product_references total_sales sales_share_percentage:4 total_quantity total_profit profit_rank average_complete_order_value average_order_value_rank comparable_profit_margin_percentage margin_rank sales_profit_rank_gap average_shipping_days {_LOSS} unknown_sales_lines unknown_quantity_lines unknown_profit_lines {_COVER}",
    "period_geographic_performance": f"{_CITY} {_PERIOD} total_orders distinct_customers total_order_lines total_sales sales_share_percentage:4 total_quantity total_profit average_complete_order_value comparable_profit_margin_percentage sales_rank profit_rank margin_rank regional_sales_rank sales_profit_rank_gap {_DAYS} two_day_or_less_orders two_day_or_less_percentage eight_plus_day_orders eight_plus_day_percentage {_LOSS} unknown_sales_lines unknown_quantity_lines unknown_profit_lines {_COVER}",
    "period_logistics_performance": f"ship_mode is_unknown_ship_mode {_PERIOD} first_observed_order_date last_observed_order_date total_orders order_share_percentage distinct_customers total_order_lines usage_rank {_DAYS} shipping_speed_rank {_FAST} total_sales sales_rank total_quantity total_profit profit_rank average_complete_order_value comparable_profit_margin_percentage sales_profit_rank_gap {_LOSS} orders_with_unknown_sales orders_with_unknown_profit unknown_sales_lines unknown_quantity_lines unknown_profit_lines {_COVER}",
}

LAYOUTS: dict[str, str] = {**VIEWS, **BUSINESS, **CATEGORY, **PRODUCT, **CUSTOMER, **GEOGRAPHY, **LOGISTICS, **PERIOD}
