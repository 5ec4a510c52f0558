"""fathom: DataFrame operators for survey-style analytics on Spark."""
