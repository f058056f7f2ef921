"""Reading schema statements and keeping the schemas they describe. All of it runs on the driver, on text."""
