"""How the operators combine: bronze to silver, silver to gold, questions asked of gold."""
