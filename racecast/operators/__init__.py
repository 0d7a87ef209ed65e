"""DataFrame operators: cleaning, features, joins, exploration."""
