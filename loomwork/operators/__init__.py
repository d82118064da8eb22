"""DataFrame operators. Each takes DataFrames and returns one; none runs an action unless it says so."""
