"""DataFrame → DataFrame operators.

``aggregates``  per-key rates, sums, means (raw or pre-aggregated), counts
``profile``     wide per-entity profile joins, flags, labels
``risk``        rule score, banding, hash split, logistic model, exact AUC
``indicators``  per-group indicators, reasons and shares, KPI row
``explore``     filters, search, top-N, histogram, box, facets, detail
``quality``     primary-key, NOT NULL and foreign-key violation reports
"""
