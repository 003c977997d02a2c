"""Spark operators that prepare labelled data for modelling and judge the results."""
