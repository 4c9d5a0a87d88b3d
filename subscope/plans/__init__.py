"""Jobs composed of the operators: ETL, profiling, training and streaming."""
