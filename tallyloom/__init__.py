"""tallyloom: relational feature engineering and scoring as Spark DataFrame plans."""
