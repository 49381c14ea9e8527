"""Process analytics on Spark: model queries, cleaning, event logs, forecasting and text over DataFrames."""
