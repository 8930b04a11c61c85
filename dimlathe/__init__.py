"""dimlathe: build and maintain a dimensional warehouse with Spark DataFrames."""
