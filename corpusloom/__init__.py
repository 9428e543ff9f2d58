"""corpusloom: corpus preparation, labelling and scoring as Spark DataFrame operators."""
