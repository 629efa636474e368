"""Order analytics as reusable Spark DataFrame operators.

Raw order, item, product, payment and review tables go in; one-row-per-order
feature tables, review-sentiment models and holdout predictions come out.
"""
