"""Every operator as a query over the test tables, with an equal SQL text where one exists."""
