"""Growing degree hours for farm fields, computed with Spark DataFrames."""
