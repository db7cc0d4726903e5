def prose(rng, n, words="the of sun moon river stone walks under quiet long bright green seven open door".split()):
    return " ".join(rng.choice(words) for _ in range(n))
