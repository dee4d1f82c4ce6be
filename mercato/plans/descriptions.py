"""Comments on tables and columns. They are part of the contract: the audit stops a
run that publishes an object or column without one."""

from __future__ import annotations

TABLES = {
    "clients": "Clients, cleaned and typed, one row per tax id, oldest registration kept.",
    "client_merges": "Every client id merged away, with the client it now means.",
    "orders": "Orders, typed; net value is zero when cancelled.",
    "products": "Products, typed.",
    "lines": "Order lines, typed; returns are marked and kept.",
    "reps": "Sales reps, typed.",
    "visits": "Visits of reps to clients, typed.",
    "payments": "Payments of orders, typed.",
    "portfolio": "Which rep looks after which client; rows of reps who left are marked.",
    "opportunities": "Sales opportunities, typed, won and lost from the closed stages.",
    "stock": "Stock snapshots, typed, with stock-outs.",
    "dim_client": "One row per client: profile, buying history, days since the last order.",
    "client_grams": "Search index: each client under all runs of three letters of its name and city.",
    "dim_product": "One row per product: catalogue attributes and whether it is discontinued.",
    "dim_rep": "One row per rep: team, target, whether still employed.",
    "dim_calendar": "One row per day from the first to the last order.",
    "fact_sales": "Sales at order-line grain. Cancelled orders are out, returns are in and negative.",
    "rep_month_sums": "Sums of each rep and month, kept up from the changed months of the sales.",
    "product_month_sums": "Sums of each product and month, kept up from the changed months of the sales.",
    "mart_rep_month": "Rep by month: sales against target.",
    "mart_product_month": "Product by month: sales and ABC class.",
    "mart_receivables": "Month due: what is owed, what came in, how late, what fees cost.",
    "monthly_revenue": "One row per month: revenue, margin, margin share, peak flag.",
    "brand_ranking": "One row per brand: rank, revenue, margin share, share of all revenue.",
    "category_margin": "One row per category: revenue and margin share, ranked by both.",
    "clients_at_risk": "One row per client without an order for more than 90 days: last order, mean monthly revenue.",
    "launch_effect": "One row per launched product: daily revenue in the 120 days after launch and since.",
    "stockout_by_brand": "One row per brand: snapshots, snapshots without stock, their share.",
    "features_train": "Client features at the training cutoff, with the label.",
    "features_score": "Client features at the scoring cutoff.",
    "propensity_scores": "Probability of buying within the horizon, per client.",
    "holdout_calibration": "Holdout by score quartile: does the buying rate rise with the score?",
    "model_metrics": "One row per training: AUC, lift, baselines, version.",
    "model_versions": "Saved models and where they are.",
    "model_aliases": "Which version an alias means; the newest row holds.",
    "run_ledger": "One row per step run: how it ended, the versions it read and wrote.",
    "weekly_queue": "The best clients to call this week, only for reps still employed.",
}

COLUMNS = {
    "slot": "Part of the search index, by a hash of the run of letters.",
    "gram": "Run of three letters of the name or city, lower case, without accents.",
    "line_id": "Order line, the grain of the sales table.",
    "order_id": "Order.",
    "client_id": "Client, after merging of duplicate registrations.",
    "merged_id": "Client id found in old orders and no longer in use.",
    "merged_count": "How many other ids were merged into this client; client_merges lists them.",
    "merged_rows": "Registrations sharing the tax id.",
    "rep_id": "Sales rep.",
    "sku": "Product.",
    "tax_id": "Tax id, 14 digits as text.",
    "legal_name": "Name of the client, words capitalised, single blanks.",
    "segment": "Kind of business of the client.",
    "city": "City of the client.",
    "state": "State.",
    "district": "District of the client.",
    "registered_on": "Registration date, from either date format.",
    "active": "In use: product on sale, client active, rep employed.",
    "ordered_on": "Order date.",
    "channel": "Sales channel.",
    "status": "Order status as delivered.",
    "total_value": "Order value, cancelled or not.",
    "net_value": "Order value, zero when cancelled; negative when returns outweigh sales.",
    "cancelled": "Order was cancelled.",
    "year": "Year.",
    "month": "Month, 1 to 12.",
    "title": "Product name.",
    "category": "Product category.",
    "brand": "Product brand.",
    "note": "Scent note of the product.",
    "list_price": "Catalogue price.",
    "unit_cost": "Cost of one unit today.",
    "unit": "Unit of sale.",
    "launched_on": "Launch date; NULL if unknown.",
    "discontinued": "Product is no longer sold.",
    "quantity": "Units, negative for a return.",
    "unit_price": "Price charged per unit.",
    "revenue": "Quantity times price; negative for returns.",
    "cost": "Quantity times unit cost.",
    "margin": "Revenue less cost, before discounts and freight.",
    "is_return": "The line is a return.",
    "rep_name": "Rep name, not unique.",
    "region": "Sales region.",
    "monthly_target": "Revenue target per month.",
    "first_order_on": "First order that stands.",
    "last_order_on": "Last order that stands.",
    "total_orders": "All orders, cancelled ones included.",
    "net_revenue": "Value of all orders that stand.",
    "days_since_order": "Days since the last order that stands; NULL if none.",
    "day": "Calendar day.",
    "month_name": "Name of the month.",
    "quarter": "Quarter, 1 to 4.",
    "weekday": "Name of the weekday.",
    "peak_month": "Peak month of the trade; the months after a peak are expected to be low.",
    "attainment": "Revenue over monthly target; 1 is on target.",
    "clients": "Distinct clients.",
    "ticket": "Revenue per order.",
    "margin_pct": "Margin in percent of revenue.",
    "abc_class": "A up to 80 percent of all revenue, B up to 95, else C; over the whole period.",
    "amount_due": "Amount falling due.",
    "received": "Amount paid, in time or late.",
    "mean_days_late": "Mean delay of late payments, in days.",
    "fee_cost": "Amount charged less amount received after fees.",
    "orders": "Distinct orders.",
    "share_pct": "Share of all revenue, in percent.",
    "monthly_revenue": "Mean revenue per month while buying.",
    "launch_revenue": "Revenue in the launch window.",
    "rest_revenue": "Revenue after the launch window.",
    "launch_per_day": "Revenue per day in the launch window.",
    "rest_per_day": "Revenue per day afterwards.",
    "snapshots": "Stock snapshots.",
    "stock_outs": "Snapshots with nothing in stock.",
    "stock_out_pct": "Stock-outs in percent of snapshots.",
    "recency_days": "Days from the last order to the cutoff.",
    "order_count": "Orders up to the cutoff.",
    "revenue_total": "Revenue up to the cutoff.",
    "mean_ticket": "Revenue per order up to the cutoff.",
    "cycle_days": "Mean days between orders; NULL with one order.",
    "overdue_ratio": "Recency over cycle; NULL without a cycle.",
    "days_since_first_order": "Days from the first order to the cutoff.",
    "days_since_registration": "Days from registration to the cutoff.",
    "recent_orders": "Orders in the recent window.",
    "recent_revenue": "Revenue in the recent window.",
    "recent_share_pct": "Recent revenue in percent of all; NULL if none.",
    "distinct_categories": "Categories bought.",
    "distinct_brands": "Brands bought.",
    "units": "Units bought, returns left out.",
    "return_rate_pct": "Returned lines in percent of lines.",
    "recent_visits": "Visits in the recent window.",
    "days_since_visit": "Days since the last visit; NULL if never visited.",
    "open_opportunities": "Opportunities open at the cutoff.",
    "multichannel": "Bought through more than one channel.",
    "buys_next": "1 if the client orders within the horizon after the cutoff, else 0.",
    "cutoff": "Nothing after this day was used.",
    "score": "Probability of buying within the horizon.",
    "band": "Quartile of the score.",
    "buyers": "Clients who bought.",
    "mean_score": "Mean score.",
    "buying_rate": "Share of clients who bought.",
    "rep": "Rep name, with the id where two share it.",
    "position": "Place in the queue of the rep, best first.",
    "reason": "Why to call.",
    "advice": "What to offer.",
    "auc": "Area under the ROC curve on the holdout.",
    "lift": "Hit rate of the best scores over the base rate.",
    "hits": "Buyers among the best scores.",
    "base_rate": "Share of buyers.",
    "baseline_recency": "AUC of recency alone.",
    "baseline_revenue": "AUC of revenue alone.",
    "baseline_overdue": "AUC of the overdue ratio alone.",
    "best_feature": "Feature whose shuffling costs most AUC.",
    "version": "Model version.",
    "trained_at": "Time of training.",
    "scored_at": "Time of scoring.",
    "name": "Model name.",
    "path": "Folder of the saved model.",
    "alias": "Alias.",
    "saved_at": "Time of saving.",
    "set_at": "Time the alias was set.",
}
